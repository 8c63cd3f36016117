from brooktext.__main__ import arguments, run, source_options, trigger_of
from brooktext.sources import wire
from brooktext.sources.workspace import new_folder
from brooktext.streaming.store import ModelStore
from pyspark.sql import functions as F


def test_train_score_and_count(spark, records, capsys):
    wire_dir, models, counts = (new_folder(spark, p) for p in ("wire", "models", "counts"))
    wire.to_wire(records.withColumn("chunk", F.lit(0)), "chunk").select("value").write.text(wire_dir)
    common = ["--path", wire_dir, "--models-dir", models]
    run(spark, arguments(["train", *common, "--models", "MNB", "SGD", "--width", "50", "--loss", "hinge", "--labels", "4", "0"]))
    run(spark, arguments(["score", *common, "--keep-predictions", "--literal-divisor"]))
    run(spark, arguments(["count", "--path", wire_dir, "--out", counts]))
    shown = capsys.readouterr().out
    assert "mean_accuracy" in shown and "MNB" in shown and "total" in shown
    assert ModelStore(spark, models).width == 50
    batches = new_folder(spark, "counts")
    run(spark, arguments(["count", "--path", wire_dir, "--out", batches, "--counts", "batch"]))
    assert " n|" in capsys.readouterr().out


def test_no_command_has_a_limit_of_its_own():
    for command in ("train", "score", "count"):
        assert arguments([command]).max_batches is None


def test_sources_and_triggers():
    socket = arguments(["train", "--source", "socket"])
    assert source_options(socket) == {"host": "localhost", "port": "6100"}
    assert trigger_of(socket) == {"processingTime": "5 seconds"}
    count = arguments(["count", "--source", "socket", "--port", "1234"])
    assert source_options(count)["port"] == "1234"
    assert trigger_of(count) == {"processingTime": "2 seconds"}
    kafka = arguments(["score", "--source", "kafka", "--option", "subscribe=texts", "--interval", "1 second"])
    assert source_options(kafka) == {"subscribe": "texts"}
    assert trigger_of(kafka) == {"processingTime": "1 second"}
    assert trigger_of(arguments(["train", "--path", "x"])) is None
