import re
from collections import Counter

import corpus_pipeline
from made_up import words
from brooktext.llm.queries import QUERIES
from brooktext.sources.workspace import new_folder

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, lines string, gone_doc int, id int"


def letters(seed, n):
    """Words without digits, so that a language can be told."""
    return [re.sub(r"\d", lambda m: "abcdefghij"[int(m.group())], w) for w in words(seed, n)]


def rows():
    out = [(i, " ".join(letters(i, 40 + i % 30)), "aa", "ab"[i % 2]) for i in range(60)]
    out += [(100 + i, out[i][1], "aa", "a") for i in range(4)]  # exact copies
    near = letters(3, 200)
    out += [(200, "\n".join(" ".join(near[k : k + 20]) for k in range(0, 200, 20)), "aa", "a")]
    near[7] = "edited"
    out += [(201, " ".join(near), "aa", "b")]  # the same words as one line
    near[90] = "again"
    out += [(202, " ".join(near), "aa", None)]
    out += [(300, " ".join([*letters(500, 30), *letters(900, 25), *letters(501, 9)]), "aa", "a")]  # holds a test item
    out += [(400, None, "aa", "a"), (401, "12 34 !!", "aa", "a"), (402, "", None, None), (None, "some text here", "aa", "a")]
    return [(*row, len(row[1] or ""), "x", 1, 2) for row in out]


def folder(spark, documents):
    path = new_folder(spark, "tables")
    spark.createDataFrame(documents, SCHEMA).write.parquet(f"{path}/documents.parquet")
    items = [(1, " ".join(letters(900, 25))), (2, "short"), (3, None)]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_pipeline_keeps_and_drops_what_it_should(spark):
    path = folder(spark, rows())
    given = spark.read.parquet(f"{path}/documents.parquet")
    docs, kept = given, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialize(stage(spark, docs, path), "stage")
        assert docs.columns[: len(given.columns)] == given.columns
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.schema.simpleString() == given.schema.simpleString()
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    clean = set(range(60))
    assert set(kept["language id"]) == {*clean, 100, 101, 102, 103, 200, 201, 202, 300, None}
    # The copies lose their only line; everything else keeps its text.
    assert set(kept["line dedup"]) == {*clean, 200, 201, 300, None}
    assert all(kept["line dedup"][i] == kept["language id"][i] for i in clean)
    assert set(kept["near dedup"]) == {*clean, 200, 300, None}
    assert set(kept["decontamination"]) == {*clean, 200, None}
    mixed = docs.collect()
    assert {r["doc_id"] for r in mixed} <= set(kept["decontamination"])
    assert all(1 <= r["mix_copies"] <= 3 for r in mixed)
    sizes, taken = Counter(), Counter()
    by_id = {r["doc_id"]: r for r in given.collect()}
    for doc_id, text in kept["decontamination"].items():
        sizes[by_id[doc_id]["source"]] += len(text.split())
    for r in mixed:
        taken[r["source"]] += r["mix_taken"]
    total = sum(sizes.values())
    assert abs(taken["a"] - total / 3) <= 40 and abs(taken["b"] - total * 2 / 3) <= 40
    again = corpus_pipeline.run(spark, path).collect()
    assert sorted((repr(r["doc_id"]), r["mix_copies"]) for r in again) == sorted((repr(r["doc_id"]), r["mix_copies"]) for r in mixed)


def line_stage(spark, texts):
    docs = spark.createDataFrame([(i, t, "aa", "a", len(t), "x", 1, 2) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, "").collect()}


def test_line_stage_links_lines_of_short_words_with_one_typo(spark):
    line = "we go up to it as we do so in an hour or by an end of day if he is on at noon"
    other = "a line of its own that is like no other one"
    typo = line.replace("hour", "hoxr")
    # Of 24 shingles of 8 characters the typo breaks two or three, of 12 characters four.
    assert line_stage(spark, [line, f"{typo}\n{other}"]) == {0: line, 1: other}


def test_line_stage_takes_lines_of_few_words(spark):
    script = "".join(chr(0x4E00 + k * 37 % 900) for k in range(120))
    changed = script[:50] + "x" + script[51:]
    same_start = script[:40] + "".join(chr(0x5E00 + k * 41 % 900) for k in range(80))
    short, other = "Of, then.", "a line of its own that is like no other one"
    texts = [f"{short}\n{script}", f"{changed}\n{other}", f" {short.upper()}\n{same_start}\nOf, thus."]
    assert line_stage(spark, texts) == {0: texts[0], 1: other, 2: f"{same_start}\nOf, thus."}


def test_line_stage_leaves_no_husk_of_a_copy(spark):
    line, other = "a line that all of these documents hold", "Not yet."
    copy = f"{line}\n\nOf, then.\n  "
    texts = [copy, copy, copy, f"{line}\n\n{other}", "\n", ""]
    # Copies go with their blank and short lines; a line of its own keeps a document, and so does having lost none.
    assert line_stage(spark, texts) == {0: copy, 3: f"\n{other}", 4: "\n", 5: ""}


def test_every_stage_takes_an_empty_table(spark):
    path = folder(spark, [])
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, path).collect() == []
    assert corpus_pipeline.run(spark, path).collect() == []


def test_all_queries_are_registered():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
