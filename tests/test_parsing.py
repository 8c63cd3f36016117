from pyspark.sql import functions as F

from brooktext.sources.workspace import new_folder
from brooktext.functions.text import field_at, prefix_drop, row_concat, split_first, tokenize
from brooktext.sources import wire

SAMPLE = r'["Sentiment,Tweet\n", "0,hello, world \"q\" \\ x\n", "4,ünï 中\n"]'


def lines(spark, *values):
    return spark.createDataFrame([(value,) for value in values], "value string")


def test_decoding_parser_gives_the_records(spark):
    rows = wire.parse_wire(lines(spark, SAMPLE)).select("sentiment", "message", "reject").collect()
    assert [tuple(row) for row in rows] == [
        ("Sentiment", "Tweet", None),
        ("0", 'hello, world "q" \\ x', None),
        ("4", "ünï 中", None),
    ]


def test_literal_splitter_keeps_escapes_and_tail(spark):
    rows = wire.split_wire_literally(lines(spark, SAMPLE)).collect()
    assert [tuple(row) for row in rows] == [
        ("Sentiment", "Tweet"),
        ("0", r"hello, world \"q\" \\ x"),
        ("4", r'ünï 中\n"]'),
    ]


def test_bad_records_are_kept_with_a_reason(spark):
    values = ["", "plain no comma", '["0,ok\\n", "no separator here\\n", null]', None]
    rows = wire.parse_wire(lines(spark, *values)).select("record", "message", "reject").collect()
    assert [tuple(row) for row in rows] == [
        ("", None, "not_json"),
        ("plain no comma", None, "not_json"),
        ("0,ok", "ok", None),
        ("no separator here", None, "no_separator"),
        (None, None, "null_record"),
        (None, None, "not_json"),
    ]


def test_no_record_is_lost_or_made_up(spark):
    """Text after the array, and elements that are no strings, come out as rejects."""
    values = ['["0,a"]["1,b"]', '["0,a\\n"] junk ["1,b"]', '["0,a"], "b": 3', '["0,a\\n", ["1,b"], {"k":"1,z"}, 5, "4,b"]', '["0,x",']
    rows = wire.parse_wire(lines(spark, *values)).select("record", "reject").collect()
    assert [tuple(row) for row in rows] == [
        (values[0], "not_json"),
        (values[1], "not_json"),
        (values[2], "not_json"),
        ("0,a", None),
        ('["1,b"]', "not_a_string"),
        ('{"k":"1,z"}', "not_a_string"),
        ("5", "not_a_string"),
        ("4,b", None),
        (values[4], "not_json"),
    ]


def test_headers_and_nulls_are_dropped(spark):
    rows = [("Sentiment", "Tweet"), ("0", "a"), (None, "b"), ("4", None), ("4", "")]
    df = spark.createDataFrame(rows, "sentiment string, message string")
    assert [tuple(r) for r in wire.drop_headers(df).collect()] == [("0", "a"), ("4", None), ("4", "")]
    assert [tuple(r) for r in wire.drop_nulls(wire.drop_headers(df)).collect()] == [("0", "a"), ("4", "")]


def test_encoding_and_decoding_are_inverse(spark):
    texts = ["plain", 'quote " and \\ and /', "two\nlines\n", "tab\there", "", "a,b,,c", "ünï 中   end", "\n"]
    rows = [(i, "0", text) for i, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "row_id bigint, sentiment string, message string")
    encoded = wire.to_wire(df.withColumn("chunk", F.floor(F.col("row_id") / 3)), "chunk")
    assert encoded.where(F.col("value").contains("\n")).isEmpty()
    decoded = wire.drop_headers(wire.parse_wire(encoded))
    assert sorted(r.message for r in decoded.collect()) == sorted(texts)


def test_small_text_functions(spark):
    df = spark.createDataFrame([("x;y,z", "ab"), ("plain", "a")], "line string, short string")
    head, tail = split_first(F.col("line"), ",")
    rows = df.select(
        head.alias("head"),
        tail.alias("tail"),
        field_at(F.col("line")).alias("first"),
        field_at(F.col("line"), 1).alias("second"),
        prefix_drop(F.col("short"), 2).alias("rest"),
        row_concat("line", F.lit(None).cast("string"), "short").alias("joined"),
    ).collect()
    assert tuple(rows[0]) == ("x;y", "z", "x", "y,z", "", "x;y,zab\n")
    assert tuple(rows[1]) == ("plain", None, "plain", None, "", "plaina\n")


def test_tokens_are_lower_case_ascii_words(spark):
    df = spark.createDataFrame([("Ab_1, cÉd!!  X",), ("",), ("...",)], "message string")
    assert [r.t for r in df.select(tokenize(F.col("message")).alias("t")).collect()] == [
        ["ab_1", "c", "d", "x"],
        [],
        [],
    ]


def test_a_long_line_is_read_by_many_tasks(spark):
    texts = [f"text {k}, with \"quotes\", back\\slash \\n and ünï\ttab" + " x" * (k % 50) for k in range(600)]
    texts[7:10] = ['", "', 'ends in "', "\\n"]
    rows = [(k, str(k % 2), text) for k, text in enumerate(texts)]
    records = spark.createDataFrame(rows, "row_id long, sentiment string, message string")
    lines = wire.to_wire(records.withColumn("chunk", F.lit(0)), "chunk").select("value")
    bad = ['["0,alone"]', '["0,no end", "1,of line", "2"]', "no json", "[1, 2]", "", '["0,last\\n"]']
    path = new_folder(spark, "wire")
    lines.union(spark.createDataFrame([(b,) for b in bad], "value string")).coalesce(1).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192b")
    try:
        pieces = wire.read_long_lines(spark, path)
        by_task = pieces.groupBy(F.spark_partition_id().alias("task")).count().collect()
        got = sorted(tuple(r) for r in wire.parse_wire(pieces).where("reject IS NULL").select("sentiment", "message").collect())
        rejects = {r.reject for r in wire.parse_wire(pieces).collect()} - {None}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    whole = wire.parse_wire(spark.read.text(path)).where("reject IS NULL")
    assert got == sorted(tuple(r) for r in whole.select("sentiment", "message").collect())
    assert len(got) == 600 + 1 + 4 and len(by_task) > 5 and max(r["count"] for r in by_task) < 300
    assert rejects == {"no_separator", "not_json", "not_a_string"}
