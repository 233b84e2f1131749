"""Sources, sinks, incremental loads, settings and the entry points."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from lodegrain import diagnostics, schema, settings
from lodegrain.sources import readers, writers
from lodegrain.streaming import incremental


def test_lines_are_parsed_tolerantly(spark):
    lines = ["", "   ", "bad", "[1]", '{"title":"no id"}', '{"id":"","title":"t"}', '{"id":"W1","abstract":"  text "}', '{"id":"W2","abstract":null,"title":"T"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = [(r["row"]["id"] if r["row"] else None, r["text"]) for r in readers.parse_lines(df).collect()]
    assert got == [(None, "")] * 6 + [("W1", "text"), ("W2", "")]
    assert readers.parse_lines(df, fallback="title").collect()[-1]["text"] == "T"


def records(spark, n=25):
    rows = [{"id": f"W{i}", "publication_year": 2021 + i % 2, "title": "line break"} for i in range(n)]
    return spark.createDataFrame([tuple(r.get(c) for c in schema.RECORD_COLUMNS) + ("a",) for r in rows], schema.record_schema())


def test_records_are_sharded_and_read_back(spark, tmp_path):
    writers.write_records(records(spark), f"{tmp_path}/r", rows_per_part=5)
    back = readers.records(spark, f"{tmp_path}/r")
    assert back.count() == 25
    sizes = {(r["year"], r["part"]): r["rows"] for r in readers.parts(back).collect()}
    assert sizes == {(2021, 0): 5, (2021, 1): 5, (2021, 2): 3, (2022, 0): 5, (2022, 1): 5, (2022, 2): 2}
    assert readers.records(spark, f"{tmp_path}/r", years=[2022]).count() == 12
    first = writers.manifest(records(spark), 5).filter("id = 'W24'").first()
    assert first["path"] == "2021/part_0002.jsonl"
    assert readers.line_count(spark, f"{tmp_path}/r") == 25


def test_binary_vectors(spark, tmp_path):
    v = np.random.default_rng(0).standard_normal((10, 4)).astype(np.float16)
    (tmp_path / "a.f16").write_bytes(v.tobytes())
    got = sorted((r["n"], r["embedding"]) for r in readers.binary_vectors(spark, str(tmp_path / "a.f16"), 4).collect())
    assert [n for n, _ in got] == list(range(10)) and np.allclose([x for _, x in got], v.astype(np.float32))
    (tmp_path / "b.f16").write_bytes(v.tobytes()[:-2])
    with pytest.raises(Exception, match="ends within a row"):
        readers.binary_vectors(spark, str(tmp_path / "b.f16"), 4).collect()


def test_folders_are_checked(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="doesn't exist"):
        readers.check_folder(spark, f"{tmp_path}/none")
    spark.range(3).write.parquet(f"{tmp_path}/x/y")
    with pytest.raises(FileNotFoundError, match="did you mean"):
        readers.check_folder(spark, f"{tmp_path}/x")
    assert readers.check_folder(spark, f"{tmp_path}/x/y")


def test_wanted_texts_and_ids(spark):
    a = spark.createDataFrame([("W1", "x", 1), ("W2", None, 2), ("bad", "y", None), ("W9", "z", 9)], "id string, value string, id64 long")
    assert sorted(r[0] for r in readers.ids_with_text(a).collect()) == [1, 9]
    assert [r["id"] for r in readers.texts_for(a, spark.createDataFrame([(1,), (2,)], "id64 long")).orderBy("id").collect()] == ["W1", "W2"]
    assert readers.texts_for(a, spark.createDataFrame([], "id64 long")).count() == 0


def test_queries_file(spark, tmp_path):
    (tmp_path / "q.txt").write_text("one\n\n  two  \n")
    assert readers.queries_from(spark, f"file://{tmp_path}/q.txt", [" zero ", ""]) == ["zero", "one", "two"]


def batch(spark, rows):
    return spark.createDataFrame([(k, [float(x)], x) for k, x in rows], "point_id string, embedding array<float>, n int")


def test_collection_keeps_the_latest(spark, tmp_path):
    held = writers.Collection(spark, f"{tmp_path}/c", dim=1)
    assert held.read() is None and held.describe()["status"] == "empty"
    held.upsert(batch(spark, [("a", 1), ("b", 2)]))
    held.upsert(batch(spark, [("b", 3), ("c", 4)]))
    held.upsert(batch(spark, [("b", 3), ("c", 4)]), 2)  # the same load again
    rows = lambda: sorted((r["point_id"], r["n"]) for r in held.read().collect())
    assert rows() == [("a", 1), ("b", 3), ("c", 4)]
    held.compact()
    assert rows() == [("a", 1), ("b", 3), ("c", 4)] and held.describe()["segments"] == 1
    held.upsert(batch(spark, [("a", 9)]))
    assert rows()[0] == ("a", 9) and held.describe()["points"] == 3
    with pytest.raises(Exception, match="a vector of 1 where 2"):
        writers.Collection(spark, f"{tmp_path}/d", dim=2).upsert(batch(spark, [("a", 1)]))
    with pytest.raises(ValueError, match="lack"):
        held.check(spark.range(1))
    with pytest.raises(ValueError):
        held.delete()
    held.recreate(confirm=True)
    assert held.read() is None


def test_new_files_are_loaded_once(spark, tmp_path):
    kind = T.StructType([T.StructField("point_id", T.StringType()), T.StructField("n", T.IntegerType())])
    held = writers.Collection(spark, f"{tmp_path}/c")
    points = lambda df: df.withColumn("embedding", F.array(F.lit(1.0).cast("float")))
    put = lambda name, rows: (tmp_path / "in").mkdir(exist_ok=True) or (tmp_path / "in" / name).write_text("\n".join(json.dumps(dict(zip(("point_id", "n"), r))) for r in rows))
    run = lambda: incremental.load_new(spark, f"{tmp_path}/in", kind, held, points, f"{tmp_path}/cp")
    put("1.json", [("a", 1), ("b", 2)])
    assert run() == 1 and run() == 0
    put("2.json", [("b", 3)])
    assert run() == 1
    assert sorted((r["point_id"], r["n"]) for r in held.read().collect()) == [("a", 1), ("b", 3)]
    incremental.restart(spark, f"{tmp_path}/cp")
    assert run() == 1 and held.read().count() == 2
    assert incremental.append_new(spark, f"{tmp_path}/in", kind, lambda d: d.filter("n > 1"), f"{tmp_path}/out", f"{tmp_path}/cp2", "json") == 1
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2 and incremental.is_done(spark, f"{tmp_path}/out/batch=0") and not incremental.is_done(spark, f"{tmp_path}/none")


def test_settings(tmp_path, monkeypatch):
    (tmp_path / ".env").write_text("# note\nLIMIT=7\nDIM=x\nYEARS=1999,2000\nATTACH_COUNTRY=0\nbad line\n")
    environ = settings.load_env_file(tmp_path / ".env", {"LIMIT": "9"})
    got = settings.Settings.from_env(environ)
    assert (got.limit, got.dim, got.years, got.attach_country) == (9, 1024, (1999, 2000), False)
    monkeypatch.chdir(tmp_path)
    (tmp_path / "here").mkdir()
    assert settings.resolve("here", "/else") == tmp_path / "here" and str(settings.resolve("gone", "/else")) == "/else/gone" and str(settings.resolve("/abs")) == "/abs"
    assert settings.human_bytes(1536) == "1.5 KiB" and settings.human_bytes(3) == "3 B" and settings.part_label(2021, 3) == "2021/part_0003.jsonl"
    assert settings.Workspace("s3://b/").records == "s3://b/records"


def test_diagnostics(spark):
    assert diagnostics.timed(lambda: 1 / 0)[2] == "ZeroDivisionError" and diagnostics.timed(lambda: 3)[0] == 3
    assert [diagnostics.trend(x) for x in ([4.0, 1.0], [4.0, 3.9], [4.0, 2.5], [1.0])] == ["warming", "not cache", "mixed", "unknown"]
    got = diagnostics.ladder(lambda limit, ef: spark.range(limit))
    assert [(r["limit"], r["ef"], r["error"]) for r in got] == [(1, 16, None), (10, 64, None), (50, 128, None)]
    assert [r["setting"] for r in diagnostics.one_at_a_time(lambda n: spark.range(n), {"n": 1}, {"n": [1, 2]})] == ["base", "n=2"]
    stages = diagnostics.Stages()
    assert stages.run("a", lambda: 5) == 5 and "a" in stages.seconds
    assert len(diagnostics.model_bench(len, [1, 2])["warm"]) == 2


def test_entry_points():
    import __spark_entry__ as entry

    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and "knn_exact_topk" in sql


def test_command_line_from_dump_to_hits(spark, tmp_path, capsys):
    from lodegrain import cli

    blank = {c: None for c in schema.WORK_COLUMNS}
    works = [blank | {"id": f"https://x/W{i}", "title": t, "publication_year": "2021"} for i, t in enumerate(["Green cat", "Blue dog", "No text"])]
    spark.createDataFrame([tuple(r[c] for c in schema.WORK_COLUMNS) for r in works], schema.WORKS).write.parquet(f"{tmp_path}/w")
    spark.createDataFrame([("W0", '{"green":[0],"cat":[1]}'), ("W1", '{"blue":[0],"dog":[1]}'), ("W2", None)], schema.ABSTRACTS).write.parquet(f"{tmp_path}/a")
    run = lambda *a: cli.main([str(x) for x in a], spark)
    assert run("prepare", "--works", f"{tmp_path}/w", "--abstracts", f"{tmp_path}/a", "--out", f"{tmp_path}/r") == 0
    assert run("load", "--records", f"{tmp_path}/r", "--collection", f"{tmp_path}/c") == 0
    assert "'points': 2" in capsys.readouterr().out
    assert run("search", "--collection", f"{tmp_path}/c", "-q", "blue dog", "--year", 2021) == 0
    assert json.loads(capsys.readouterr().out)[0]["title"] == "Blue dog"
    assert run("search", "--collection", f"{tmp_path}/c", "-q", "cat", "--keyword", "--no-rerank", "--out", f"{tmp_path}/o.json") == 0
    assert [h["openalex_id"] for h in json.loads((tmp_path / "o.json").read_text())] == ["https://x/W0"]
    assert run("search", "--collection", f"{tmp_path}/none", "-q", "x") == 1 and run("search", "--collection", f"{tmp_path}/c") == 2
