"""What the operators and the pipeline's stages do on rows that are out of the ordinary."""

import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodegrain.llm import audio, common, components, decontamination, language_id, license_scan, near_duplicates, quality, queries, secret_scan, token_files, vocab
from test_training_data import brute_components, brute_report, by_row, edited, prose

CLASH = "__id long, __hash long, __hits string, __bad string, gone_id string, own_row string, hit_id string, HIT_WORDS string, node string, text_hash string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASH


def doc(i, text, lang="en"):
    return (i, text, lang, "s", len(text or ""), 1, 2, *"abcdefgh")


# Word ids


def test_word_ids_after_letters_that_change_when_lowered():
    from tokenizers import Tokenizer

    path = queries.vocabulary("word_bpe_49k.json")
    encoder, library = vocab.WordIds(vocab.read_file(path)), Tokenizer.from_file(path)
    r = random.Random(7)
    letters = [chr(c) for c in range(0x21, 0x250)] + ["İ"] * 40 + [".", ",", "!", "&", "|", " ", "\n"] * 12 + [chr(c) for c in range(0x300, 0x320)]
    texts = ["ANKARA İLİ, TÜRKİYE", "SAHİBİ. Bu", "İ.", "İ", "ŉ,"] + ["".join(r.choice(letters) for _ in range(r.randint(1, 30))) for _ in range(6000)]
    for t in texts:
        assert np.frombuffer(encoder.encode([t])[0], encoder.dtype).tolist() == library.encode(t, add_special_tokens=False).ids, repr(t)


def test_what_workers_remember_is_bounded(monkeypatch):
    monkeypatch.setattr(vocab, "MEMORY", 1 << 16)
    encoder = vocab.WordIds(vocab.read_file(queries.vocabulary("word_bpe_49k.json")))
    for k in range(40):
        encoder.encode([" ".join(f"w{k}x{i}" for i in range(100))])
        assert len(encoder.known) < 2000


# Near duplicates


def test_keep_one_judges_rows_by_their_text(spark):
    a, b = prose(1, 60), prose(2, 60)
    for order in ([(3, a), (7, a), (7, b)], [(7, b), (7, a), (3, a)]):
        got = near_duplicates.keep_one(spark.createDataFrame([doc(*x) for x in order], DOCS).coalesce(1)).collect()
        assert sorted((r["doc_id"], r["text"]) for r in got) == [(3, a), (7, b)]
    nulls = [doc(None, a), doc(None, a), doc(None, b), doc(None, None), doc(None, None), doc(5, b + " more")]
    got = near_duplicates.keep_one(spark.createDataFrame(nulls, DOCS)).collect()
    assert sorted((r["doc_id"] is None, r["text"] or "") for r in got) == sorted([(True, a), (False, b + " more"), (True, ""), (True, "")])
    assert got[0].asDict().keys() == {f.split()[0] for f in DOCS.split(", ")}


def test_links_between_members_that_differ_from_their_centre(spark, monkeypatch):
    """A group whose members are linked in chains and rings, and in part not at all."""
    monkeypatch.setattr(near_duplicates, "BLOCK_MEMBERS", 4)
    docs, i = [], 0
    for family in range(4):
        text = prose(300 + family, 220)
        for step in range(14):
            docs.append((i, text))
            docs.append((i + 1, edited(text, 7000 + i, 0.03)))
            text, i = edited(text, i, 0.012), i + 2
    random.Random(3).shuffle(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert by_row(near_duplicates.cluster(df)) == brute_components(docs)
    assert by_row(near_duplicates.cluster(df, 80)) == brute_components(docs, 80)


def test_components_are_a_union_find(spark):
    r = random.Random(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(i + 1, i) for i in range(300, 360)] + [(500, k) for k in range(501, 600)] + [(r.randrange(100), r.randrange(100)) for _ in range(60)]
    edges = [e for e in edges if e[0] != e[1]]
    name = {v: v for e in edges for v in e}
    for _ in range(300):
        for a, b in edges:
            name[a] = name[b] = min(name[a], name[b])
    got = components.connected(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["v"]: r["root"] for r in got} == name and len(got) == len(name)


# Decontamination


def test_a_table_beyond_the_bound_is_shuffled_with_the_same_result(spark):
    passage = prose(50, 20)
    items = [(1, passage), (2, "One short ITEM"), (20, passage)]
    docs = [(0, passage), (1, f"{prose(51, 300)} {passage}!! {prose(52, 400)}"), (2, "a one short item"), (3, None), (4, "")] + [(k, prose(k, 3000)) for k in range(10, 14)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = decontamination.report(d, b, broadcast_bytes=-1)
        assert by_row(out) == sorted(brute_report(docs, items))
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        # What the windows carry to the exchange is their own words, not the document's.
        assert all("d_words" not in line.split("Exchange")[0] for line in plan.split("\n") if "own_words" in line and "Exchange" in line)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# Secrets


def test_literals_of_every_syntax():
    found = lambda t: [t[a:b] for a, b in secret_scan.assigned_literals(t)]
    assert found('{"secret": {"value": "q8Zr5tLm2x"}, "value": "q8Zr5tLm2y"}') == ["q8Zr5tLm2x"]
    assert found("secret:\n  value: q8Zr5tLm2x\nother:\n  value: q8Zr5tLm2y") == ["q8Zr5tLm2x"]
    assert found('db_password = "abc12" + "def34XYZ"') == ["abc12", "def34XYZ"]
    assert found('db_password = (\n  "abc12"\n  "def34XYZ")') == ["abc12", "def34XYZ"]
    assert found('key = """q8Zr5\ntLm2xAA99"""\nz = 1') == ["q8Zr5\ntLm2xAA99"]
    assert found("private_key: |\n  MIIabc123def\n  zzz999qqq\nother: 1") == ["MIIabc123def\n  zzz999qqq"]
    assert found("auth_tokens = 3\nauth = ['q8Zr5tLm2x', 'q8Zr5tLm2y']") == ["q8Zr5tLm2x", "q8Zr5tLm2y"]


def test_literal_spans_are_brute_force():
    """Flat assignments, some of them of names: every literal is walked on its own."""
    r = random.Random(5)
    names = ["a", "b", "c", "user_key", "token1x", "title", "salt", "host", "db_pwd", "passphrase"]
    values = ["q8Zr5tLm2x", "plainwords", "short", "q8Zr 5tLm 2xyz", "1234567890", "correct horse battery"]
    for _ in range(400):
        rows = [(r.choice(names), r.choice(values) if r.random() < 0.5 else None, r.choice(names)) for _ in range(r.randint(1, 9))]
        text = "\n".join(f'{n} = "{v}"' if v else f"{n} = {m}" for n, v, m in rows)
        defined, want, at = {n for n, *_ in rows}, [], 0
        for n, v, m in rows:
            value = v or m
            start = at + len(n) + 3 + bool(v)
            if v or m not in defined:
                reach = {n}
                while more := {x for x, w, y in rows if not w and y in reach} - reach:
                    reach |= more
                weight = max(round(10 * secret_scan.sensitivity(x)) for x in reach)
                mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
                phrase = any(p in secret_scan.PHRASES for x in reach for p in secret_scan.parts_of(x))
                score = weight + 5 * (mixed and secret_scan.entropy(value) >= 3) - 5 * ((" " in value and not phrase) or (not mixed and value.isalpha() and value.islower()))
                if weight and len(value) >= 8 and score >= 9:
                    want.append((start, start + len(value)))
            at += len(n) + 3 + len(value) + 2 * bool(v) + 1
        assert secret_scan.assigned_literals(text) == want, text


@pytest.mark.parametrize("text", ["\n".join(f'secret_{i} = "q8Zr5tLm2x{i}"' for i in range(30_000)), "\n".join(f"n{i} = n{i + 1}" for i in range(60_000)) + "\nn60000 = 1\nkey = n0", 'key a="' * 130_000, "key" + "{value:" * 140_000, "x" * 1_000_000 + "=key"])
def test_long_texts_take_linear_time(text):
    began = time.process_time()
    secret_scan.scan_text(text)
    assert time.process_time() - began < 6  # some 2 s at a megabyte here; walking back would take minutes


# Media


def test_log_mel_is_the_direct_sum():
    samples = np.random.default_rng(2).integers(0, 256, 5000).astype(np.uint8)
    signal = audio.resample((samples.astype(np.float32) - 128) / 128)
    got = audio.log_mel(samples)
    assert len(got) == 1 + (len(signal) - audio.WINDOW) // audio.HOP
    k = np.arange(audio.WINDOW)
    hann = 0.5 - 0.5 * np.cos(2 * np.pi * k / audio.WINDOW)
    for f in (0, 1, len(got) - 1):
        frame = signal[f * audio.HOP : f * audio.HOP + audio.WINDOW] * hann
        power = np.array([abs((frame * np.exp(-2j * np.pi * b * k / audio.WINDOW)).sum()) ** 2 for b in range(audio.WINDOW // 2 + 1)])
        want = [np.log10(sum(power[b] * audio.mel_bank()[b, m] for b in range(len(power))) + 1e-6) for m in range(audio.BANDS)]
        assert np.allclose(got[f], want, atol=1e-3)


def test_blocks_give_what_the_whole_gives(monkeypatch):
    samples = np.random.default_rng(3).integers(0, 256, 40_001).astype(np.uint8)
    whole = audio.log_mel(samples)
    monkeypatch.setattr(audio, "BLOCK", 7)
    assert np.allclose(audio.log_mel(samples), whole, atol=1e-5)


def test_hysteresis_is_a_walk():
    r = np.random.default_rng(4)
    for _ in range(200):
        energy = r.random(30).round(2)
        level = (energy - energy.min()) / (energy.max() - energy.min())
        want, opened = [], None
        for i, x in enumerate([*level, -1.0]):
            if opened is None and x >= 0.5:
                opened = i
            elif opened is not None and x < 0.25:
                want.append((opened, i))
                opened = None
        assert audio.segments(energy) == want


# Licences


def test_cosines_and_inheritance_are_brute_force(spark):
    known = license_scan.Templates(license_scan.TEMPLATES)
    forms = [(name, license_scan.terms(f)) for name, many in sorted(license_scan.TEMPLATES.items()) for f in many]
    idf = lambda t: np.log((1 + len(forms)) / (1 + sum(t in bag for _, bag in forms))) + 1
    vector = lambda bag: {t: n * idf(t) for t, n in bag.items()}
    length = lambda v: np.sqrt(sum(x * x for x in v.values()))
    for text in ("Released under the MIT licence, more or less.", "GNU General Public License version 3", "nothing", license_scan.TEMPLATES["ISC"][1][:90]):
        v = vector(license_scan.terms(text))
        scores = [(-round(sum(x * w.get(t, 0) for t, x in v.items()) / length(v) / length(w), 9), name) for name, bag in forms for w in [vector(bag)]]
        assert known.best(text)[0] == pytest.approx(min(scores)[0], abs=1e-8)
    r = random.Random(6)
    paths = ["/".join(r.choice("abc") for _ in range(r.randint(0, 4))) + f"/f{i}" for i in range(120)]
    rows = [(i, p, r.choice([None, None, None, "MIT", "ISC"]), 0.9, 1, 1.0) for i, p in enumerate(paths)]
    got = {x["doc_id"]: (x["effective_license"], x["inherited_from"]) for x in license_scan.inherit(spark.createDataFrame(rows, license_scan.SCANNED)).collect()}
    held = {}
    for _, p, name, *_ in rows:
        at = p.rsplit("/", 1)[0]
        if name:
            held[at] = min(name, held.get(at, name))
    for i, p, name, *_ in rows:
        at, want = p.rsplit("/", 1)[0], (name, None)
        while name is None:
            if held.get(at):
                want = (held[at], at)
                break
            if not at:
                break
            at = at.rsplit("/", 1)[0] if "/" in at else ""
        assert got[i] == want, p


# Bounds of what is learnt


def test_quality_learns_from_a_bounded_number_of_rows(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {k}") for k in range(500)] + [(i, prose(i, 20)) for i in range(2, 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 40)] + [(1, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "Discriminant", lambda x, y: seen.append(len(y)))
    quality.learn(docs, labels, per_class=100)
    quality.learn(docs, labels, per_class=2)
    assert seen == [39, 4]


def test_languages_and_their_runs_are_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 30), f"l{i % 5}") for i in range(50)] + [(i, prose(i, 30), "l0") for i in range(50, 60)], "doc_id long, text string, lang string")
    assert language_id.learn(docs, most_languages=2).languages == ["l0", "l1"]
    monkeypatch.setattr(language_id, "MOST_RUNS", 10)
    with pytest.raises(ValueError):
        language_id.learn(docs)


def test_remembered_code_lengths_are_those_of_the_trees(spark, monkeypatch):
    docs = spark.createDataFrame([(i, prose(i, 30), f"l{i % 2}") for i in range(50)], "doc_id long, text string, lang string")
    model = language_id.learn(docs)
    texts = [prose(900 + i, 40) + "é漢" * (i % 3) for i in range(30)] + ["", "x"]
    want, _ = model.bits(texts)
    monkeypatch.setattr(language_id, "BLOCK", 1)
    small = language_id.CodeLengths({"l0": (np.array([1]), np.array([1]))})
    small.languages, small.trees, small.bits_of_slots = model.languages, model.trees, 6
    assert np.allclose(small.bits(texts)[0], want) and np.allclose(small.bits(texts)[0], want)


# Files and scratch


def test_failed_attempts_leave_nothing(spark, tmp_path):
    docs = spark.createDataFrame([(i, prose(i, 50)) for i in range(20)], "doc_id long, text string")
    (tmp_path / "shard-0000000.arrow.dead.part").write_bytes(b"x")
    token_files.write(docs, f"file://{tmp_path}", queries.vocabulary("word_bpe_49k.json"), shard_bytes=1000)
    names = [p.name for p in tmp_path.iterdir()]
    assert len(names) > 4 and all(n.endswith((".arrow", ".index")) or n.endswith(".crc") for n in names)


def test_settled_tables_can_be_dropped(spark):
    kept = common.settle(spark.range(5), "five")
    path = kept._lodegrain_scratch
    assert kept.count() == 5
    common.drop(kept)
    assert not spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path))


# The pipeline's stages


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("stages")
    passage = prose(50, 20)
    rows = [doc(i, prose(i, 60), "en" if i % 2 else "de") for i in range(12)]
    rows += [doc(None, None), doc(5, None), doc(6, ""), doc(3, prose(3, 60)), doc(3, prose(33, 60)), doc(None, prose(77, 30)), doc(None, prose(77, 30)), doc(40, prose(40, 40_000)), doc(41, prose(41, 700) + " " + passage), doc(42, prose(42, 30) + " password=abcdefgh12")]
    for name, keep in (("full", True), ("empty", False)):
        spark.createDataFrame([r for r in rows if keep], DOCS).write.parquet(f"{at}/{name}/documents.parquet")
        spark.createDataFrame([(1, passage)][: int(keep)], "item_id long, text string").write.parquet(f"{at}/{name}/benchmark.parquet")
    return str(at), rows


def test_stages_on_empty_tables(spark, folders):
    held = spark.read.parquet(f"{folders[0]}/empty/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        held = stage(spark, held, f"{folders[0]}/empty")
        held.write.parquet(f"{folders[0]}/empty/{n}")
        held = spark.read.parquet(f"{folders[0]}/empty/{n}")
        assert held.count() == 0


def test_stages_on_nulls_repeated_rows_long_texts_and_clashing_names(spark, folders):
    at, rows = folders
    held = spark.read.parquet(f"{at}/full/documents.parquet")
    columns, kept = held.columns, []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, held, f"{at}/full")
        assert out.columns == columns
        out.write.parquet(f"{at}/full/{n}")
        held = spark.read.parquet(f"{at}/full/{n}")
        kept.append(held.collect())
        assert all(r["__id"] == 1 and r["text_hash"] == "h" for r in kept[-1])
    worded = [(r[0], r[1]) for r in rows if r[1]]
    order = lambda pairs: sorted(pairs, key=lambda p: (p[0] is None, p[0] or 0, p[1]))
    assert order((r["doc_id"], r["text"]) for r in kept[0]) == order(worded)
    assert order((r["doc_id"], r["text"]) for r in kept[1]) == order(set(worded))
    texts = {r["doc_id"]: r["text"] for r in kept[3]}
    assert texts[41].strip() == prose(41, 700) and "abcdefgh12" not in texts[42] and texts[40] == prose(40, 40_000)
    pieces = corpus_pipeline.STAGES[-1][1](spark, held, f"{at}/full").collect()
    assert sum(r["start"] == 0 for r in pieces) == len(kept[3])
