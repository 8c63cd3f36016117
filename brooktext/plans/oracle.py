"""SQL that states independently what each query should return.

Written for DuckDB over the given tables. Term hashing is spelled out in SQL
(Murmur3 x86 32 bit, seed 42, UTF-8), so the feature queries share no code with
the engine.
"""

from __future__ import annotations

from brooktext.functions.features import TRAIN_WIDTH, WIDE_WIDTH
from brooktext.functions.sharded import SHARDED_WIDTH
from brooktext.sources.arrivals import ARRIVALS
from brooktext.sources.feed import FEED_ROWS
from brooktext.sources.tables import EVENTS_PER_BATCH, RECORD_IDS_PER_BATCH

ORACLES: dict[str, str] = {}


def _mul(x: str, c: int) -> str:
    return f"((({x})::HUGEINT * {c}) % 4294967296)::UBIGINT"


def _rot(x: str, r: int) -> str:
    return f"(((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295::UBIGINT)"


def _little_endian(start: str, size: int) -> str:
    digits = " || ".join(f"substr(h, ({start}) * 2 + {2 * (size - i) - 1}, 2)" for i in range(size))
    return f"('0x' || {digits})::UBIGINT"


def _mixed(x: str) -> str:
    return _mul(_rot(_mul(x, 3432918353), 15), 461845907)


TOKENS = r"list_filter(string_split_regex(lower(message), '\W'), lambda t: length(t) >= 1)"

RECORDS = """records AS (
  SELECT d.doc_id AS row_id, CAST(l.quality AS VARCHAR) AS sentiment, d.text AS message
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

LABELS = """label_map AS (
  SELECT sentiment, CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS DOUBLE) AS label
  FROM (SELECT CAST(quality AS VARCHAR) AS sentiment FROM labels) GROUP BY sentiment),
labelled AS (
  SELECT r.row_id, r.sentiment, r.message, m.label FROM records r JOIN label_map m ON r.sentiment = m.sentiment)"""

TEXTS = "texts AS (SELECT doc_id AS row_id, text AS message FROM documents)"


def _term_counts(source: str, width: int) -> str:
    """``tf(row_id, bucket, tf)`` of the messages in ``source``."""
    steps = "xor(acc::UBIGINT, x::UBIGINT)"
    return f"""tokens AS (SELECT row_id, unnest({TOKENS}) AS term FROM {source}),
counts AS (SELECT row_id, term, count(*) AS n FROM tokens GROUP BY row_id, term),
terms AS (SELECT DISTINCT term, hex(encode(term)) AS h, octet_length(encode(term)) AS n FROM counts),
blocks AS (
  SELECT term, h, n,
    list_transform(list_transform(range(0, n // 4), lambda i: {_little_endian("i * 4", 4)}), lambda k: {_mixed("k")}) AS b,
    CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN {_little_endian("n - 1", 1)}
      WHEN 2 THEN {_little_endian("n - 2", 2)} ELSE {_little_endian("n - 3", 3)} END AS tail
  FROM terms),
mixed AS (
  SELECT term, n, {_mixed("tail")} AS tail,
    list_reduce(list_prepend(42::UBIGINT, b),
      lambda acc, x: ((({_rot(steps, 13)})::HUGEINT * 5 + 3864292196) % 4294967296)::UBIGINT) AS acc
  FROM blocks),
f1 AS (SELECT term, xor(xor(acc, tail), n::UBIGINT) AS a FROM mixed),
f2 AS (SELECT term, {_mul("xor(a, a >> 16)", 2246822507)} AS a FROM f1),
f3 AS (SELECT term, {_mul("xor(a, a >> 13)", 3266489909)} AS a FROM f2),
f4 AS (SELECT term, xor(a, a >> 16)::BIGINT AS a FROM f3),
buckets AS (
  SELECT term, CAST((((CASE WHEN a >= 2147483648 THEN a - 4294967296 ELSE a END) % {width}) + {width}) % {width}
    AS INTEGER) AS bucket FROM f4),
tf AS (
  SELECT row_id, bucket, CAST(sum(c.n) AS BIGINT) AS tf
  FROM counts c JOIN buckets b ON c.term = b.term GROUP BY row_id, bucket)"""


def _slots(width: int) -> str:
    """``slots(row_id, label, slot, x)``: term counts and a bias of 1."""
    return f"""slots AS (
  SELECT t.row_id, l.label, t.bucket AS slot, CAST(t.tf AS DOUBLE) AS x
  FROM tf t JOIN labelled l ON t.row_id = l.row_id
  UNION ALL SELECT row_id, label, {width}, 1.0 FROM labelled),
every_slot AS (SELECT CAST(unnest(range(0, {width + 1})) AS INTEGER) AS slot)"""


def _learning(width: int = TRAIN_WIDTH) -> str:
    return ",\n".join([RECORDS, LABELS, _term_counts("labelled", width), _slots(width)])


def _nb_weights(width: int) -> str:
    return f"""nb_sums AS (
  SELECT e.slot, coalesce(sum(x) FILTER (label = 0), 0) AS n0, coalesce(sum(x) FILTER (label = 1), 0) AS n1
  FROM every_slot e LEFT JOIN slots s ON e.slot = s.slot GROUP BY e.slot),
nb_totals AS (
  SELECT sum(n0) FILTER (slot < {width}) AS t0, sum(n1) FILTER (slot < {width}) AS t1 FROM nb_sums),
nb_weights AS (
  SELECT slot, CASE WHEN slot < {width}
    THEN ln(n1 + 0.0001) - ln(t1 + 0.0001 * {width}) - ln(n0 + 0.0001) + ln(t0 + 0.0001 * {width})
    ELSE ln(n1) - ln(n0) END AS w FROM nb_sums, nb_totals)"""


def _sgd_weights(width: int) -> str:
    """One step of the log loss from zero weights: rate 10, residual 0.5 - label."""
    return f"""sgd_weights AS (
  SELECT slot, -10.0 * sum(x * (0.5 - label)) / (SELECT count(*) FROM labelled) AS w FROM slots GROUP BY slot)"""


def _kmeans_start(width: int) -> str:
    return f"""c0 AS (
  SELECT slot, x AS c FROM slots WHERE slot < {width} AND row_id = (SELECT min(row_id) FROM labelled)),
far AS (
  SELECT s.row_id, sum(s.x * s.x) - 2 * sum(s.x * coalesce(c0.c, 0)) AS d
  FROM slots s LEFT JOIN c0 ON s.slot = c0.slot GROUP BY s.row_id),
c1 AS (
  SELECT slot, x AS c FROM slots
  WHERE slot < {width} AND row_id = (SELECT row_id FROM far ORDER BY d DESC, row_id LIMIT 1)),
start AS (
  SELECT e.slot, coalesce(c0.c, 0) AS c0, coalesce(c1.c, 0) AS c1
  FROM every_slot e LEFT JOIN c0 ON e.slot = c0.slot LEFT JOIN c1 ON e.slot = c1.slot WHERE e.slot < {width})"""


def _distance_margin(centres: str, name: str) -> str:
    """Squared distance to the first centre minus that to the second, per row."""
    return f"""{name} AS (
  SELECT l.row_id, any_value(l.label) AS label,
    coalesce(sum(2 * s.x * (c.c1 - c.c0)), 0) + (SELECT sum(c0 * c0 - c1 * c1) FROM {centres}) AS margin
  FROM labelled l JOIN slots s ON l.row_id = s.row_id LEFT JOIN {centres} c ON s.slot = c.slot GROUP BY l.row_id)"""


def _kmeans_step(width: int) -> str:
    return f"""{_kmeans_start(width)},
{_distance_margin("start", "assigned")},
sizes AS (
  SELECT count(*) FILTER (NOT margin > 0) AS m0, count(*) FILTER (margin > 0) AS m1 FROM assigned),
centres AS (
  SELECT st.slot,
    CASE WHEN any_value(m0) > 0 THEN coalesce(sum(s.x) FILTER (NOT a.margin > 0), 0) / any_value(m0)
      ELSE any_value(st.c0) END AS c0,
    CASE WHEN any_value(m1) > 0 THEN coalesce(sum(s.x) FILTER (a.margin > 0), 0) / any_value(m1)
      ELSE any_value(st.c1) END AS c1
  FROM start st CROSS JOIN sizes LEFT JOIN slots s ON s.slot = st.slot LEFT JOIN assigned a ON a.row_id = s.row_id
  GROUP BY st.slot)"""


def _margin(weights: str, name: str) -> str:
    return f"""{name} AS (
  SELECT s.row_id, any_value(s.label) AS label, sum(s.x * w.w) AS margin
  FROM slots s JOIN {weights} w ON s.slot = w.slot GROUP BY s.row_id)"""


CELLS = """count(*) AS n,
  count(*) FILTER (label = 0 AND p = 0) AS tn, count(*) FILTER (label = 0 AND p = 1) AS fp,
  count(*) FILTER (label = 1 AND p = 0) AS fn, count(*) FILTER (label = 1 AND p = 1) AS tp"""

RATES = """round((tp + tn) / n, 6) AS accuracy,
  round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 6) AS "precision",
  round(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 6) AS recall"""

DECISION = "CASE WHEN margin > 0 THEN 1.0 ELSE 0.0 END"

_BATCH = f"CAST(floor(row_id / {RECORD_IDS_PER_BATCH}) AS BIGINT)"
_LABEL_BATCH = f"CAST(floor(doc_id / {RECORD_IDS_PER_BATCH}) AS BIGINT)"
_EVENT_BATCH = f"CAST(floor(event_id / {EVENTS_PER_BATCH}) AS BIGINT)"


def _arrival(key: str, table: str) -> str:
    low, high = f"(SELECT min({key}) FROM {table})", f"(SELECT max({key}) FROM {table})"
    size = f"CAST(ceil(({high} - {low} + 1) / {ARRIVALS}.0) AS BIGINT)"
    return f"CAST(floor(({key} - {low}) / {size}) AS BIGINT)"


_RECORD_ARRIVAL = _arrival("doc_id", "documents")
_EVENT_ARRIVAL = _arrival("event_id", "events")

# --- sources and parsing -----------------------------------------------------

ORACLES["text_stream_scan"] = f"""
SELECT batch_id, count(DISTINCT chunk) AS n_lines FROM (
  SELECT {_RECORD_ARRIVAL} AS batch_id, {_LABEL_BATCH} AS chunk
  FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) GROUP BY batch_id"""

ORACLES["csv_feed_scan"] = """
SELECT CAST(event_id AS VARCHAR) AS "ID", event_type AS "language",
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS "Date", CAST(user_id AS VARCHAR) AS "Userid",
  CAST(length(props) AS INTEGER) AS len, user_id AS followers
FROM events"""

ORACLES["rate_limited_scan"] = f"""
SELECT n // {FEED_ROWS} AS batch_id, count(*) AS n_rows
FROM (SELECT row_number() OVER () - 1 AS n FROM events) GROUP BY 1"""

ORACLES["wire_parse"] = f"WITH {RECORDS} SELECT {_BATCH} AS batch_id, sentiment, message FROM records"

ORACLES["wire_parse_split"] = f"WITH {RECORDS} SELECT sentiment, message FROM records"

ORACLES["wire_split_literal"] = f"""
WITH {RECORDS},
quoted AS (
  SELECT {_BATCH} AS batch_id, row_id,
    CAST(to_json(sentiment || ',' || message || chr(10)) AS VARCHAR) AS q FROM records),
lines AS (
  SELECT batch_id, '["Sentiment,Tweet\\n", ' || string_agg(q, ', ' ORDER BY row_id) || ']' AS line
  FROM quoted GROUP BY batch_id),
pieces AS (SELECT batch_id, substr(unnest(string_split(line, '\\n",')), 3) AS piece FROM lines)
SELECT batch_id, substr(piece, 1, strpos(piece, ',') - 1) AS sentiment,
  substr(piece, strpos(piece, ',') + 1) AS message
FROM pieces WHERE substr(piece, 1, strpos(piece, ',') - 1) <> 'Sentiment'"""

ORACLES["header_filter"] = f"""
WITH {RECORDS}
SELECT {_BATCH} AS batch_id, count(*) + 1 AS n_all, count(*) AS n_kept FROM records GROUP BY 1"""

ORACLES["null_drop"] = """
SELECT d.doc_id AS row_id, CAST(l.quality AS VARCHAR) AS sentiment, CAST(length(d.text) AS INTEGER) AS n_chars
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL AND d.text IS NOT NULL"""

ORACLES["dead_letter"] = """
SELECT doc_id, CASE WHEN strpos(text, ',') = 0 THEN 'no_separator' ELSE 'unknown_label' END AS reject,
  text AS record
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""

ORACLES["prefix_drop"] = "SELECT doc_id, substr(text, 3) AS rest FROM documents"

ORACLES["split_first"] = """
SELECT doc_id, CASE WHEN strpos(text, ',') = 0 THEN text ELSE substr(text, 1, strpos(text, ',') - 1) END AS sentiment,
  CASE WHEN strpos(text, ',') > 0 THEN substr(text, strpos(text, ',') + 1) END AS message
FROM documents"""

ORACLES["first_field_key"] = """
SELECT split_part(event_type || ';' || event_id || ';' || props, ';', 1) AS key, count(*) AS n
FROM events GROUP BY 1"""

ORACLES["row_concat"] = """
SELECT event_id, concat(event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), user_id, props, chr(10)) AS line
FROM events"""

ORACLES["string_operations"] = """
SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines,
  concat(lang, substr(text, 3)) AS tag, CAST(octet_length(encode(text)) AS INTEGER) AS n_bytes
FROM documents"""

# --- features ----------------------------------------------------------------

ORACLES["tokenize"] = f"""
WITH {TEXTS}, split AS (SELECT row_id, {TOKENS} AS t FROM texts)
SELECT row_id, len(t) AS n_tokens, array_to_string(t, ' ') AS tokens FROM split"""

ORACLES["token_count"] = f"""
WITH {TEXTS}, split AS (SELECT unnest({TOKENS}) AS token FROM texts)
SELECT token, count(*) AS n FROM split GROUP BY token"""

for _width in (TRAIN_WIDTH, WIDE_WIDTH):
    ORACLES[f"hashing_tf_{_width}"] = f"""
WITH {TEXTS}, {_term_counts("texts", _width)} SELECT row_id, bucket, tf FROM tf"""

ORACLES["densify"] = f"""
WITH {TEXTS} SELECT row_id, CAST({TRAIN_WIDTH} AS BIGINT) AS n_slots, len({TOKENS}) AS n_terms FROM texts"""

ORACLES["features_and_label"] = f"""
WITH {RECORDS}, {LABELS}, {_term_counts("labelled", TRAIN_WIDTH)}
SELECT l.row_id, l.label, count(t.bucket) AS n_buckets, CAST(coalesce(sum(t.tf), 0) AS BIGINT) AS n_terms
FROM labelled l LEFT JOIN tf t ON l.row_id = t.row_id GROUP BY l.row_id, l.label"""

# --- labels and counts -------------------------------------------------------

_BATCH_LABELS = f"""batch_labels AS (
  SELECT {_LABEL_BATCH} AS batch_id, CAST(quality AS VARCHAR) AS sentiment, count(*) AS n FROM labels GROUP BY 1, 2)"""

ORACLES["label_frequency"] = f"WITH {_BATCH_LABELS} SELECT batch_id, sentiment, n FROM batch_labels"

ORACLES["label_index_per_batch"] = f"""
WITH {_BATCH_LABELS}, ranked AS (
  SELECT batch_id, sentiment,
    CAST(row_number() OVER (PARTITION BY batch_id ORDER BY n DESC, sentiment) - 1 AS DOUBLE) AS label
  FROM batch_labels)
SELECT l.doc_id AS row_id, r.batch_id, r.sentiment, r.label
FROM labels l JOIN ranked r ON {_LABEL_BATCH} = r.batch_id AND CAST(l.quality AS VARCHAR) = r.sentiment"""

ORACLES["label_index_stable"] = f"WITH {RECORDS}, {LABELS} SELECT row_id, sentiment, label FROM labelled"

_KEY_COUNTS = f"""key_counts AS (
  SELECT {_EVENT_BATCH} AS batch_id, event_type AS key, count(*) AS n FROM events GROUP BY 1, 2)"""

ORACLES["batch_key_count"] = f"WITH {_KEY_COUNTS} SELECT batch_id, key, n FROM key_counts"

ORACLES["stream_key_count"] = f"""
SELECT {_EVENT_ARRIVAL} AS batch_id, event_type AS key, count(*) AS n FROM events GROUP BY 1, 2"""

ORACLES["running_key_count"] = f"""
WITH seen AS (SELECT {_EVENT_ARRIVAL} AS arrival, event_type AS key FROM events),
batches AS (SELECT DISTINCT arrival AS batch_id FROM seen)
SELECT b.batch_id, s.key, count(*) AS total
FROM batches b JOIN seen s ON s.arrival <= b.batch_id GROUP BY b.batch_id, s.key"""

# The empty arrival stands in the middle.
ORACLES["batch_progress"] = f"""
WITH sizes AS (SELECT {_EVENT_ARRIVAL} AS arrival, count(*) AS n_rows FROM events GROUP BY 1)
SELECT CAST(arrival + (arrival >= 2)::INTEGER AS BIGINT) AS batch_id, n_rows FROM sizes
UNION ALL SELECT 2, 0"""

ORACLES["running_key_state"] = f"""
WITH seen AS (SELECT {_EVENT_ARRIVAL} AS batch_id, event_type AS key, user_id AS value FROM events),
met AS (SELECT DISTINCT batch_id, key FROM seen)
SELECT m.batch_id, m.key, count(*) AS n, CAST(sum(value) AS BIGINT) AS total, max(value) AS most
FROM met m JOIN seen s ON s.key = m.key AND s.batch_id <= m.batch_id GROUP BY m.batch_id, m.key"""

ORACLES["preview_topn"] = f"""
WITH {RECORDS} SELECT row_id, sentiment, message FROM records ORDER BY row_id LIMIT 5"""

ORACLES["preview_counts"] = f"""
WITH {_KEY_COUNTS} SELECT batch_id, key, n FROM key_counts ORDER BY batch_id, key LIMIT 10"""

# --- learning ----------------------------------------------------------------

ORACLES["nb_counts"] = f"""
WITH {_learning()}
SELECT slot, CAST(coalesce(sum(x) FILTER (label = 0), 0) AS BIGINT) AS n0,
  CAST(coalesce(sum(x) FILTER (label = 1), 0) AS BIGINT) AS n1
FROM slots GROUP BY slot"""

_NB = f"{_learning()}, {_nb_weights(TRAIN_WIDTH)}, {_margin('nb_weights', 'nb')}"
_SGD = f"{_sgd_weights(TRAIN_WIDTH)}, {_margin('sgd_weights', 'sgd')}"
_KMEANS = f"{_kmeans_step(TRAIN_WIDTH)}, {_distance_margin('centres', 'kmeans')}"

ORACLES["nb_predict"] = f"""
WITH {_NB} SELECT row_id, label, round(margin, 4) AS log_odds, CAST({DECISION} AS DOUBLE) AS prediction FROM nb"""

ORACLES["nb_predict_sharded"] = f"""
WITH {_learning(SHARDED_WIDTH)}, {_nb_weights(SHARDED_WIDTH)}, {_margin('nb_weights', 'nb')}
SELECT row_id, label, round(margin, 4) AS log_odds, CAST({DECISION} AS DOUBLE) AS prediction FROM nb"""

ORACLES["sgd_predict_sharded"] = f"""
WITH {_learning(SHARDED_WIDTH)}, {_sgd_weights(SHARDED_WIDTH)}, {_margin('sgd_weights', 'sgd')}
SELECT row_id, label, round(margin, 4) AS margin, CAST({DECISION} AS DOUBLE) AS prediction FROM sgd"""

ORACLES["confusion_matrix"] = f"""
WITH {_NB}, decided AS (SELECT label, {DECISION} AS p FROM nb), cells AS (SELECT {CELLS} FROM decided)
SELECT 'MNB' AS model, n, tn, fp, fn, tp, {RATES} FROM cells"""

ORACLES["sgd_gradient"] = f"""
WITH {_learning()} SELECT slot, sum(x * (0.5 - label)) AS gradient FROM slots GROUP BY slot"""

ORACLES["sgd_gradient_hinge"] = f"""
WITH {_learning(WIDE_WIDTH)} SELECT slot, sum(x * (1 - 2 * label)) AS gradient FROM slots GROUP BY slot"""

ORACLES["sgd_predict"] = f"""
WITH {_learning()}, {_SGD}
SELECT row_id, label, round(margin, 4) AS margin, CAST({DECISION} AS DOUBLE) AS prediction FROM sgd"""

ORACLES["kmeans_step"] = f"""
WITH {_learning()}, {_kmeans_step(TRAIN_WIDTH)}
SELECT slot, round(c0, 6) AS centre0, round(c1, 6) AS centre1 FROM centres"""

ORACLES["kmeans_many_step"] = f"""
WITH {_learning()},
firsts AS (SELECT row_id, CAST(row_number() OVER (ORDER BY row_id) - 1 AS INTEGER) AS centre FROM labelled ORDER BY row_id LIMIT 5),
start AS (SELECT centre, slot, x FROM slots JOIN firsts USING (row_id) WHERE slot < {TRAIN_WIDTH}),
lengths AS (SELECT centre, coalesce(sum(x * x), 0) AS square FROM firsts LEFT JOIN start USING (centre) GROUP BY centre),
products AS (
  SELECT s.row_id, c.centre, sum(s.x * c.x) AS product
  FROM slots s JOIN start c ON c.slot = s.slot GROUP BY s.row_id, c.centre),
nearest AS (
  SELECT l.row_id, arg_min(n.centre, (n.square - 2 * coalesce(p.product, 0), n.centre)) AS centre
  FROM labelled l CROSS JOIN lengths n LEFT JOIN products p ON p.row_id = l.row_id AND p.centre = n.centre GROUP BY l.row_id),
sizes AS (SELECT f.centre, count(n.row_id) AS n_rows FROM firsts f LEFT JOIN nearest n USING (centre) GROUP BY f.centre),
sums AS (SELECT centre, slot, sum(x) AS x FROM slots JOIN nearest USING (row_id) GROUP BY centre, slot)
SELECT z.centre, e.slot, z.n_rows,
  round(coalesce(CASE WHEN z.n_rows > 0 THEN m.x / z.n_rows ELSE c.x END, 0), 6) AS value
FROM sizes z JOIN every_slot e ON e.slot < {TRAIN_WIDTH}
LEFT JOIN sums m ON m.centre = z.centre AND m.slot = e.slot LEFT JOIN start c ON c.centre = z.centre AND c.slot = e.slot"""

ORACLES["kmeans_predict"] = f"""
WITH {_learning()}, {_KMEANS}
SELECT row_id, label, round(margin, 3) AS margin, CAST({DECISION} AS DOUBLE) AS prediction FROM kmeans"""

# --- metrics over batches ----------------------------------------------------

_SCORED = f"""{_NB}, {_SGD}, {_KMEANS},
decided AS (
  SELECT 'MNB' AS model, row_id, label, {DECISION} AS p FROM nb
  UNION ALL SELECT 'SGD', row_id, label, {DECISION} FROM sgd
  UNION ALL SELECT 'KMEANS', row_id, label, {DECISION} FROM kmeans),
cells AS (SELECT model, {_BATCH} AS batch_id, {CELLS} FROM decided GROUP BY 1, 2)"""

ORACLES["batch_metrics"] = f"""
WITH {_SCORED}
SELECT model, batch_id, n, tn, fp, fn, tp, {RATES},
  round((greatest(tn, fn) + greatest(fp, tp)) / n, 6) AS aligned_accuracy FROM cells"""

ORACLES["mean_accuracy"] = f"""
WITH {_SCORED}
SELECT model, count(*) AS batches, round(sum((tp + tn) / n) / count(*), 6) AS mean_accuracy,
  round(sum((tp + tn) / n) / (count(*) + 1), 6) AS literal_mean FROM cells GROUP BY model"""

ORACLES["accuracy_leaderboard"] = f"""
WITH {_SCORED} SELECT model, round(avg((tp + tn) / n), 6) AS mean_accuracy FROM cells GROUP BY model"""

ORACLES["batch_counter"] = f"SELECT count(DISTINCT {_LABEL_BATCH}) AS batches FROM labels"

ORACLES["model_save_load"] = f"""
SELECT m.model, count(*) AS n, CAST(0 AS BIGINT) AS n_different
FROM labels, (SELECT unnest(['LR', 'SGD', 'MLP', 'MNB', 'KMEANS']) AS model) m GROUP BY m.model"""

# --- streams of models -------------------------------------------------------

# The stream fixes the label mapping at its first arrival.
_STREAM_LABELS = f"""arrived AS (
  SELECT doc_id AS row_id, {_RECORD_ARRIVAL} AS batch_id FROM documents),
label_map AS (
  SELECT sentiment, CAST(row_number() OVER (ORDER BY count(*) DESC, sentiment) - 1 AS DOUBLE) AS label
  FROM records r JOIN arrived a ON r.row_id = a.row_id
  WHERE a.batch_id = (SELECT min(a.batch_id) FROM records r JOIN arrived a ON r.row_id = a.row_id)
  GROUP BY sentiment),
labelled AS (
  SELECT r.row_id, r.message, a.batch_id, m.label
  FROM records r JOIN label_map m ON r.sentiment = m.sentiment JOIN arrived a ON a.row_id = r.row_id)"""


def _stream(width: int) -> str:
    return ",\n".join([RECORDS, _STREAM_LABELS, _term_counts("labelled", width), _slots(width)])


def _nb_stream(width: int, seen: str) -> str:
    """Per arrival, metrics of the model that learnt the arrivals ``seen``."""
    return f"""
WITH {_stream(width)},
part AS (
  SELECT l.batch_id, s.slot, sum(x) FILTER (s.label = 0) AS n0, sum(x) FILTER (s.label = 1) AS n1
  FROM slots s JOIN labelled l ON s.row_id = l.row_id GROUP BY 1, 2),
versions AS (SELECT DISTINCT batch_id FROM labelled),
sums AS (
  SELECT v.batch_id, e.slot, coalesce(sum(p.n0), 0) AS n0, coalesce(sum(p.n1), 0) AS n1
  FROM versions v CROSS JOIN every_slot e LEFT JOIN part p ON p.slot = e.slot AND p.batch_id {seen} v.batch_id
  GROUP BY 1, 2),
totals AS (
  SELECT batch_id, sum(n0) FILTER (slot < {width}) AS t0, sum(n1) FILTER (slot < {width}) AS t1 FROM sums GROUP BY 1),
weights AS (
  SELECT s.batch_id, s.slot, CASE WHEN slot < {width}
    THEN ln(n1 + 0.0001) - ln(t1 + 0.0001 * {width}) - ln(n0 + 0.0001) + ln(t0 + 0.0001 * {width})
    ELSE ln(n1) - ln(n0) END AS w FROM sums s JOIN totals t ON s.batch_id = t.batch_id WHERE t0 + t1 > 0),
scored AS (
  SELECT l.batch_id, l.row_id, any_value(l.label) AS label, sum(s.x * w.w) AS margin
  FROM labelled l JOIN slots s ON s.row_id = l.row_id
  JOIN weights w ON w.batch_id = l.batch_id AND w.slot = s.slot GROUP BY 1, 2),
decided AS (SELECT batch_id, label, {DECISION} AS p FROM scored),
cells AS (SELECT batch_id, {CELLS} FROM decided GROUP BY 1)
SELECT 'MNB' AS model, batch_id, n, tn, fp, fn, tp, {RATES} FROM cells"""


ORACLES["train_nb"] = _nb_stream(WIDE_WIDTH, "<=")
ORACLES["train_nb_prequential"] = _nb_stream(TRAIN_WIDTH, "<")


def _sgd_stream(width: int) -> str:
    """One hinge step per arrival, spelled out arrival by arrival."""
    parts = [_stream(width), "w0 AS (SELECT slot, CAST(0 AS DOUBLE) AS w FROM every_slot)"]
    for k in range(ARRIVALS):
        rate = 1.0 / (0.0001 * (1000 + k))
        parts.append(f"""m{k} AS (
  SELECT s.row_id, any_value(s.label) AS label, sum(s.x * w.w) AS margin
  FROM slots s JOIN labelled l ON l.row_id = s.row_id AND l.batch_id = {k} JOIN w{k} w ON w.slot = s.slot GROUP BY 1),
r{k} AS (
  SELECT row_id, CASE WHEN (2 * label - 1) * margin <= 1 THEN 1 - 2 * label ELSE 0 END AS residual FROM m{k}),
w{k + 1} AS (
  SELECT w.slot, any_value(w.w) * CASE WHEN w.slot < {width} THEN 1 - {rate!r}::DOUBLE * 0.0001::DOUBLE ELSE 1 END
    - {rate!r}::DOUBLE * coalesce(sum(s.x * r.residual), 0) / (SELECT count(*) FROM r{k}) AS w
  FROM w{k} w LEFT JOIN (SELECT s.* FROM slots s SEMI JOIN r{k} r ON r.row_id = s.row_id) s ON s.slot = w.slot
  LEFT JOIN r{k} r ON r.row_id = s.row_id GROUP BY w.slot),
p{k} AS (
  SELECT {k} AS batch_id, s.row_id, any_value(s.label) AS label, sum(s.x * w.w) AS margin
  FROM slots s JOIN labelled l ON l.row_id = s.row_id AND l.batch_id = {k} JOIN w{k + 1} w ON w.slot = s.slot
  GROUP BY s.row_id)""")
    union = " UNION ALL ".join(f"SELECT * FROM p{k}" for k in range(ARRIVALS))
    parts.append(f"decided AS (SELECT CAST(batch_id AS BIGINT) AS batch_id, label, {DECISION} AS p FROM ({union}))")
    parts.append(f"cells AS (SELECT batch_id, {CELLS} FROM decided GROUP BY 1)")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT 'SGD' AS model, batch_id, n, tn, fp, fn, tp, {RATES} FROM cells"
    )


ORACLES["train_sgd"] = _sgd_stream(WIDE_WIDTH)


def _kmeans_stream(width: int) -> str:
    """Two centres over the arrivals, spelled out arrival by arrival."""
    first = f"""keyed AS (
  SELECT r.row_id, ('0x' || substr(md5(r.sentiment || ',' || r.message), 1, 15))::BIGINT AS key
  FROM records r JOIN labelled l ON l.row_id = r.row_id AND l.batch_id = 0),
i0 AS (
  SELECT slot, any_value(x) AS c FROM slots
  WHERE slot < {width} AND row_id = (SELECT row_id FROM keyed ORDER BY key, row_id LIMIT 1) GROUP BY slot),
far AS (
  SELECT k.row_id, any_value(k.key) AS key, sum(s.x * s.x) - 2 * sum(s.x * coalesce(i0.c, 0)) AS d
  FROM keyed k JOIN slots s ON s.row_id = k.row_id LEFT JOIN i0 ON s.slot = i0.slot GROUP BY k.row_id),
i1 AS (
  SELECT slot, x AS c FROM slots
  WHERE slot < {width} AND row_id = (SELECT row_id FROM far ORDER BY d DESC, key, row_id LIMIT 1)),
sum0 AS (
  SELECT e.slot, coalesce(i0.c, 0) AS c0, coalesce(i1.c, 0) AS c1, CAST(0 AS DOUBLE) AS s0, CAST(0 AS DOUBLE) AS s1
  FROM every_slot e LEFT JOIN i0 ON e.slot = i0.slot LEFT JOIN i1 ON e.slot = i1.slot WHERE e.slot < {width}),
size0 AS (SELECT 0 AS m0, 0 AS m1)"""
    parts = [_stream(width), first]

    def margin(name: str, k: int, centres: str) -> str:
        return f"""{name} AS (
  SELECT l.row_id, any_value(l.label) AS label,
    coalesce(sum(2 * s.x * (c.c1 - c.c0)), 0) + (SELECT sum(c0 * c0 - c1 * c1) FROM {centres}) AS margin
  FROM labelled l JOIN slots s ON l.row_id = s.row_id LEFT JOIN {centres} c ON s.slot = c.slot
  WHERE l.batch_id = {k} GROUP BY l.row_id)"""

    for k in range(ARRIVALS):
        parts.append(margin(f"near{k}", k, f"sum{k}"))
        parts.append(f"""size{k + 1} AS (
  SELECT m0 + (SELECT count(*) FROM near{k} WHERE NOT margin > 0) AS m0,
    m1 + (SELECT count(*) FROM near{k} WHERE margin > 0) AS m1 FROM size{k}),
add{k} AS (
  SELECT s.slot, coalesce(sum(s.x) FILTER (NOT n.margin > 0), 0) AS a0, coalesce(sum(s.x) FILTER (n.margin > 0), 0) AS a1
  FROM slots s JOIN near{k} n ON n.row_id = s.row_id GROUP BY s.slot),
sum{k + 1} AS (
  SELECT p.slot, p.s0 + coalesce(a.a0, 0) AS s0, p.s1 + coalesce(a.a1, 0) AS s1,
    CASE WHEN z.m0 > 0 THEN (p.s0 + coalesce(a.a0, 0)) / z.m0 ELSE p.c0 END AS c0,
    CASE WHEN z.m1 > 0 THEN (p.s1 + coalesce(a.a1, 0)) / z.m1 ELSE p.c1 END AS c1
  FROM sum{k} p LEFT JOIN add{k} a ON a.slot = p.slot CROSS JOIN size{k + 1} z)""")
        parts.append(margin(f"after{k}", k, f"sum{k + 1}"))
    union = " UNION ALL ".join(f"SELECT {k} AS batch_id, label, margin FROM after{k}" for k in range(ARRIVALS))
    parts.append(f"decided AS (SELECT CAST(batch_id AS BIGINT) AS batch_id, label, {DECISION} AS p FROM ({union}))")
    parts.append(f"cells AS (SELECT batch_id, {CELLS} FROM decided GROUP BY 1)")
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT 'KMEANS' AS model, batch_id, n, tn, fp, fn, tp, {RATES} FROM cells"
    )


ORACLES["train_kmeans"] = _kmeans_stream(WIDE_WIDTH)
