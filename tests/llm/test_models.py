import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from larder.llm import decontamination, language_id, secret_scans, toxicity
from tests.llm.conftest import DOC, rows_of

SYLLABLES = {"en": ["th", "ing", "er", "an", "ed"], "de": ["sch", "ung", "ä", "ein", "keit"], "es": ["ción", "ñ", "ar", "os", "ll"]}
INSULTS = ("gronk", "blarg", "snirf")


def prose(rng, lang="en", words=30):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, lang, rng.randint(3, 80)), lang, "s", 0) for k in range(240) for lang in [rng.choice(list(SYLLABLES))]]
    rows += [(900, None, "en", "s", 0), (901, "", "de", "s", 0), (902, "123 !!", "es", "s", 0), (903, prose(rng, "de"), None, "s", 0), (903, prose(rng, "de"), None, "s", 0), (None, prose(rng), "en", "s", 0)]
    return spark.createDataFrame(rows, DOC)


def test_languages_of_held_out_documents(corpus):
    learned = corpus.filter("crc32(CAST(doc_id AS STRING)) % 4 <> 2")
    model = language_id.train(learned)
    got = language_id.predict(corpus.selectExpr("*", "1 AS score", "2 AS lettered", "'x' AS _text"), model).collect()
    assert len(got) == 246
    for r in got:
        assert 0 <= r.score <= 1
        if r.doc_id in (900, 901, 902):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    held = [r for r in got if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    rows = language_id.accepted(corpus.selectExpr("*", "7 AS score", "8 AS lettered"), model).collect()
    assert {(r.score, r.lettered) for r in rows} == {(7, 8)}
    kept = {r.doc_id for r in rows}
    assert not kept & {900, 901, 902} and len(kept & set(range(240))) > 235
    assert kept == {r.doc_id for r in got if not r.rejected}


def test_unlearned_scripts_and_junk_are_rejected(corpus):
    rng = random.Random(4)

    def words(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(40))

    strange = {"cyrillic": "абвгдежзиклмнопрст", "greek": "αβγδεζηθικλμνξοπρσ", "han": "的一是不了人我在有他", "consonants": "bcdfghjklmnpqrstvwxz"}
    rows = [(k, words(letters), name, "s", 0) for name, letters in strange.items() for k in range(20)]
    rows += [(100, prose(rng, "de") * 4000, "de", "s", 0)]
    model = language_id.train(corpus)
    got = language_id.predict(corpus.sparkSession.createDataFrame(rows, DOC), model).collect()
    for name in strange:
        assert np.mean([r.rejected for r in got if r.lang == name]) > 0.9, name
    assert [(r.lang_pred, r.rejected) for r in got if r.doc_id == 100] == [("de", False)]


def test_language_predictions_do_not_depend_on_neighbours(corpus):
    model = language_id.train(corpus)
    data = [t.encode() for t in ("schung keit", "", "a", "ciónes ñar")]
    raw, at = np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)])
    together = model.predict(raw, at)
    for k, own in enumerate(data):
        best, share = model.predict(np.frombuffer(own, np.uint8), np.array([0, len(own)]))
        assert best[0] == together[0][k] and share[0] == pytest.approx(together[1][k], abs=1e-12)


def test_no_labels_and_empty_table(corpus):
    model = language_id.train(corpus.filter("lang = 'none'"))
    assert {r.lang_pred for r in language_id.predict(corpus, model).collect()} == {"und"}
    assert language_id.predict(corpus.filter("false"), model).count() == 0
    assert toxicity.train(corpus.filter("false"), corpus.selectExpr("doc_id", "1 AS toxic")) is None
    assert {r.score for r in toxicity.score(corpus, None).collect()} == {0.0}


def test_windows_overlap_by_half():
    sizes = [0, 1, 31, 32, 33, 48, 49, 500, 30_000]
    data = [" ".join(["w"] * n).encode() for n in sizes]
    text = toxicity.Text(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]))
    start, size, before = text.windows()
    for k, n in enumerate(sizes):
        own = slice(before[k], before[k + 1])
        a, b = start[own] - text.first[k], start[own] - text.first[k] + size[own]
        assert a[0] == 0 and b[-1] == n and (size[own] <= toxicity.WINDOW).all()
        for place in range(max(0, n - 16 + 1)):
            assert ((a <= place) & (b >= place + 16)).any()


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    network = toxicity.Network()
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    word = rng.integers(0, 50, (3, 5))
    letters = rng.integers(0, 30, (3, 5, 4))
    letters[1, :, 2:] = toxicity.LETTER_BUCKETS
    mask = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [1, 0, 0, 0, 0]], np.float32)
    y = np.array([1.0, 0.0, 1.0])
    _, g = network.gradients(word, letters, mask, y)
    for name, values in network.p.items():
        at = np.unravel_index(np.argmax(np.abs(g[name])), values.shape)
        old = values[at]
        losses = []
        for step in (1e-2, -1e-2):
            values[at] = old + step
            losses.append(network.gradients(word, letters, mask, y)[0])
        values[at] = old
        assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(g[name][at], rel=0.05, abs=2e-4), name


def test_toxic_documents_are_found(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        words = prose(rng, "en", rng.randint(5, 150)).split()
        toxic = int(k % 4 == 0)
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS) + ",")
        rows.append((k, " ".join(words), "en", "s", 0))
        labels.append((k, toxic))
    rows += [(900, None, "en", "s", 0), (901, "", "de", "s", 0)]
    docs = spark.createDataFrame(rows, DOC)
    labels_df = spark.createDataFrame(labels, "doc_id long, toxic int")
    network = toxicity.train(docs, labels_df.filter("crc32(CAST(doc_id AS STRING)) % 5 <> 0"))
    got = {r.doc_id: r for r in toxicity.score(docs.selectExpr("*", "'x' AS score"), network).collect()}
    assert len(got) == 402 and got[900].score == got[901].score
    held = [(got[d].predicted, toxic) for d, toxic in labels if got[d].held_out]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _ in labels)


def test_windows_cover_whole_texts():
    words = " ".join(f"w{i}" for i in range(301)).encode()
    text = toxicity.Text(np.frombuffer(words, np.uint8), np.array([0, len(words)]))
    start, size, _ = text.windows()
    seen = set()
    for a, n in zip(start.tolist(), size.tolist()):
        seen |= set(range(a, a + n))
    assert seen == set(range(301)) and all(b < a + n for a, n, b in zip(start, size, start[1:]))


def leaks(docs, items):
    out = []
    for doc, text in docs:
        own = decontamination.shingles((text or "").encode(), 5)
        for item, passage in items:
            words = (passage or "").encode().split()
            if not words:
                continue
            n = min(5, len(words))
            wanted = decontamination.shingles(passage.encode(), n)
            found = len(wanted & (own if n == 5 else decontamination.shingles((text or "").encode(), n)))
            if found >= 0.8 * len(wanted):
                out.append((doc, item, found, len(wanted)))
    return sorted(out)


def test_leaks_equal_brute_force(spark, table, texts):
    rng = random.Random(8)
    items = [(k, prose(rng, "en", rng.randint(1, 60))) for k in range(40)] + [(90, ""), (91, None), (92, "ONE two"), (40, texts[1][1])]
    rows = [(d, t) for d, t in texts if d != 1007]
    for k in range(40):
        words = items[k][1].split()
        for edits in range(4):
            own = list(words)
            for _ in range(edits):
                own[rng.randrange(len(own))] = "changed"
            rows.append((2000 + 4 * k + edits, f"{prose(rng, 'es', 50)} {' '.join(own).upper()}\n{prose(rng, 'de', 50)}"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = rows_of(decontamination.search(table(rows, clashing=True), benchmark), "doc_id", "item_id", "n_shared", "n_shingles")
    assert found == leaks(rows, items) and found
    clean = {r.doc_id for r in decontamination.without_leaks(table(rows), benchmark).collect()}
    assert clean == {d for d, _ in rows} - {r[0] for r in found}
    assert decontamination.search(table([]), benchmark).count() == 0
    assert decontamination.search(table(rows), benchmark.filter("false")).count() == 0


def test_item_blocks_give_the_same(spark, table, texts, monkeypatch):
    items = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(texts[:12])], "item_id long, text string")
    whole = rows_of(decontamination.search(table(texts), items), "doc_id", "item_id", "containment")
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 600)
    assert rows_of(decontamination.search(table(texts), items), "doc_id", "item_id", "containment") == whole


def secret(rng):
    return "".join(rng.choice("0123456789abcdef") for _ in range(40))


def test_secrets_are_found_and_masked(spark):
    rng = random.Random(4)
    rows, real = [], {}
    for k in range(200):
        text = prose(rng, "en", 20)
        if k % 4 == 0:
            real[k] = secret(rng)
            text += f' token = "{real[k]}" ' + prose(rng, "en", 5)
        elif k % 4 == 1:
            text += f" {rng.randrange(10**15, 10**16)} and mail{k}.example.com " + prose(rng, "en", 5)
        rows.append((k, text, "en", "s", len(text)))
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0)]
    docs = spark.createDataFrame(rows, DOC)
    found = secret_scans.scan(docs).collect()
    assert {r.doc_id for r in found if r.is_secret} == set(real)
    texts = dict((r[0], r[1]) for r in rows)
    assert all(texts[r.doc_id][r.start : r.start + r.n_chars] == real[r.doc_id] for r in found if r.is_secret)
    masked = {r.doc_id: r for r in secret_scans.masked(docs).collect()}
    assert len(masked) == 202 and masked[900].text is None
    for k, own in real.items():
        assert own not in masked[k].text and secret_scans.MASK in masked[k].text and masked[k].n_chars == len(masked[k].text)
    assert all(masked[k].text == texts[k] for k in range(200) if k % 4)
    assert secret_scans.scan(docs.filter("false")).count() == 0
    assert secret_scans.scan(docs.filter("doc_id % 4 = 2")).count() == 0


def test_secrets_are_judged_by_themselves(spark):
    """Bare keys are found, placeholders after a name are not; short and dotted secrets are candidates."""
    rng = random.Random(9)
    upper, mixed_ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    rows, real, fake = [], {}, {}
    for k in range(300):
        text, kind = prose(rng, "en", 20), k % 6
        if kind == 0:
            real[k] = "".join(rng.choice(mixed_) for _ in range(40))
            text += f' api_key = "{real[k]}" '
        elif kind == 1:
            real[k] = "AKIA" + "".join(rng.choice(upper) for _ in range(16))
            text += f" {real[k]} "
        elif kind == 2:
            fake[k] = rng.choice((f"/usr/lib/{prose(rng, 'en', 1)}/ssl{k}.key", f"your-example-key-{k}", "x" * 24 + str(k)))
            text += f' api_key = "{fake[k]}" '
        elif kind == 3:
            text += f" {rng.randrange(10**15, 10**16)} mail{k}.example.com "
        rows.append((k, text + prose(rng, "en", 5), "en", "s", 0))
    docs = spark.createDataFrame(rows, DOC)
    found = secret_scans.scan(docs).collect()
    texts = {r[0]: r[1] for r in rows}
    secrets = {r.doc_id: texts[r.doc_id][r.start : r.start + r.n_chars] for r in found if r.is_secret}
    assert np.mean([secrets.get(k) == v for k, v in real.items()]) > 0.95
    assert not set(secrets) & set(fake)
    labels = {r.candidate: r.label for r in secret_scans.weak_labels(secret_scans.findings(docs)).collect()}
    assert all(labels[v] == 1 for v in real.values()) and all(labels[v] == 0 for v in fake.values())


def test_short_dotted_and_digit_free_runs_are_candidates():
    wanted = ("hunter2", "Tr0ub4dor!", "pa$$w0rd%9", "correcthorse", "eyJhbGciOi.eyJzdWIiOi.SflKxwRJSM", "abcDEFghiJKLmnop", "QWERtyUIopASdf")
    for own in wanted:
        for text in (f'password: "{own}".', f"PASSWORD={own}. And"):
            assert own in [text[a:b] for a, b in secret_scans.candidates(text)], text
    assert list(secret_scans.candidates("Ordinary sentence, with Words. Nothing.here!")) == []


def test_words_come_from_all_documents(spark):
    """More documents than a sample of 2,000, each counted once for a word."""
    rows = [(k, f"common word{'' if k % 2 else ' common common'}", "en", "s", 0) for k in range(5000)]
    rows += [(None, "nameless", "en", "s", 0), (None, None, "en", "s", 0)] + [(9000 + k, f"rare{'abcdefghij'[k]} twice twice", "de", "s", 0) for k in range(10)]
    words = secret_scans.corpus_words(spark.createDataFrame(rows, DOC))
    assert words.words == {"common", "word", "nameless", "twice", *(f"rare{c}" for c in "abcdefghij")}
    assert words.pairs["tw"] < words.pairs["wo"] == words.pairs["co"]


def test_rare_labels_are_learned(spark):
    """A language and a label far below one in the sample's rows are sampled, and unusable rows take no place."""
    rng = random.Random(12)
    rows = [(k, prose(rng, "de" if k % 100 == 7 else "en", 20), "de" if k % 100 == 7 else "en", "s", 0) for k in range(2000)]
    rows += [(k, "12 !", "es", "s", 0) for k in range(5000, 5300)]
    docs = spark.createDataFrame(rows, DOC)
    model = language_id.train(docs, sample_rows=12)
    assert model.languages == ["de", "en"]
    model = language_id.train(docs)
    got = {r.doc_id: r.lang_pred for r in language_id.predict(docs.filter("doc_id < 2000"), model).collect()}
    assert np.mean([got[k] == "en" for k in got if k % 100 != 7]) > 0.97
    assert np.mean([got[k] == "de" for k in got if k % 100 == 7]) > 0.5
    labels = docs.selectExpr("doc_id", "int(doc_id % 100 = 7) AS toxic")
    assert toxicity.train(docs, labels, sample_rows=12) is not None
    assert toxicity.train(docs, labels.filter("toxic = 0"), sample_rows=12) is None


def test_subwords_take_little_memory_beside_their_batch():
    """A worker shares an executor's memory with others; slices of a megabyte took more than 40 MB at once."""
    import tracemalloc

    import pyarrow as pa

    from larder.llm.common import frugal

    texts = [f"some text of number {k} that is about a kilobyte long " * 20 for k in range(4000)]
    batch = pa.record_batch({"lang": ["en"] * len(texts), "text": texts})
    tracemalloc.start()
    rows = sum(out.num_rows for out in frugal(language_id._features)(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and most < 35e6


def test_workers_get_small_batches(spark):
    from larder.llm import common

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"n": pa.array([batch.num_rows]), "size": pa.array([batch.nbytes])})

    before = spark.conf.get(common.BATCH_SETTING, None)
    rows = spark.range(3000, numPartitions=1).selectExpr("id", "repeat('x', 2000) AS text")
    try:
        spark.conf.unset(common.BATCH_SETTING)
        got = common.mapped(rows, sizes, "n long, size long").collect()
        assert sum(r.n for r in got) == 3000
        assert max(r.size for r in got) <= 2 * common.BATCH_BYTES
        common.usual_batches(spark)
        assert spark.conf.get(common.BATCH_SETTING, None) is None
        spark.conf.set(common.BATCH_SETTING, 4 << 20)  # a session's own bound stays
        common.mapped(rows, sizes, "n long, size long")
        assert int(spark.conf.get(common.BATCH_SETTING)) == 4 << 20
    finally:
        spark.conf.unset(common.BATCH_SETTING) if before is None else spark.conf.set(common.BATCH_SETTING, before)


def test_limits_of_labels_need_no_python_workers(spark):
    from larder.llm.common import lowest_of_each

    rows = spark.sql("SELECT id AS doc_id, IF(id % 3 = 0, 'a', 'b') AS lang, xxhash64(id) AS place FROM range(300)")
    got = lowest_of_each(rows, "lang", {"a": 100, "b": 200}, 20)
    assert {r.lang: r["count"] for r in got.groupBy("lang").count().collect()} == {"a": 20, "b": 20}
    assert "Scan ExistingRDD" not in got._jdf.queryExecution().toString()
    assert lowest_of_each(rows.limit(0), "lang", {}, 20).collect() == []
