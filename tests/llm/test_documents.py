"""Operators on document texts against plain versions, and on odd rows."""

import json
import math
import os
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle

import corpus_pipeline
from keepsight.llm import language, near_duplicates as near, packing, ppm, store, toxicity
from keepsight.llm.language import identify_language
from keepsight.llm.mixing import mix, mix_report, targets
from keepsight.llm.near_duplicates import near_duplicates
from keepsight.llm.packing import WordEncoder, class_lengths, pack
from keepsight.llm.quality import judge_quality
from keepsight.llm.queries import vocabulary_path
from keepsight.llm.recurrent import Network

from .conftest import ODD

SMALL = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def sample(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def rows(sample):
    return sample.collect()


# packing


def check_packing(found, rows, capacity):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path())
    want = Counter()
    for doc, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        want[doc, ids.tobytes()] += 1
    pieces = defaultdict(list)
    for r in found:
        pieces[r.sequence_id].append(r)
        assert zlib.crc32(np.array(r.token_ids, "<u4").tobytes()) == r.ids_crc32
        assert len(r.token_ids) == r.length > 0
    for own in pieces.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0] + [r.length for r in own[:-1]]).tolist()
        assert sum(r.length for r in own) <= capacity
    docs = defaultdict(list)
    for r in found:
        docs[r.doc_id].append(r)
    have = Counter()
    for doc, own in docs.items():
        own.sort(key=lambda r: r.start)
        if len({r.doc_tokens for r in own}) == 1 and sum(r.length for r in own) == own[0].doc_tokens:
            have[doc, np.array([i for r in own for i in r.token_ids], "<u4").tobytes()] += 1
    single = {k: n for k, n in want.items() if sum(m for (d, _), m in want.items() if d == k[0]) == 1}
    assert all(have[k] == 1 for k in single)
    assert sum(r.length for r in found) == sum(len(b) // 4 * n for (_, b), n in want.items())
    lengths = [sum(r.length for r in own) for own in pieces.values()]
    return sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths) / sum(lengths)


def test_packing_round_trip(sample, rows):
    found = pack(sample, vocabulary_path(), with_ids=True).collect()
    plain = [(r.doc_id, r.text) for r in rows]
    assert check_packing(found, plain, 4096) < 0.01


def test_packing_odd_rows(documents):
    found = pack(documents(ODD), vocabulary_path(), capacity=64, classes=8, with_ids=True).collect()
    check_packing(found, ODD, 64)
    assert pack(documents([]), vocabulary_path()).count() == 0


def test_class_lengths():
    assert class_lengths(12, 3).tolist()[1:] == [1, 2, 3, 4, 4, 6, 6, 6, 6, 6, 6, 12]


# toxicity


def test_gradient():
    network = Network({b"ab": 1, b"cd": 2})
    x, _, _ = network.inputs([b"ab", b"cd", b"zz"])
    index = np.array([[0, 1, 2], [2, 0, 0]])
    real = np.array([[True, True, True], [True, True, False]])
    pooled = np.array([[False, True, True], [False, True, False]])
    slope = np.array([0.3, -0.7])

    def loss():
        return float(network.forward(x[index], real, pooled)[0] @ slope)

    logits, kept = network.forward(x[index], real, pooled)
    grads, d_x = network.backward(slope, kept)
    for name, place in (("w", (1, 2, 3)), ("u", (0, 1, 9)), ("b", (1, 0, 20)), ("attend", (4,)), ("out", (9,))):
        step = 1e-6
        network.p[name][place] += step
        up = loss()
        network.p[name][place] -= 2 * step
        down = loss()
        network.p[name][place] += step
        assert math.isclose((up - down) / (2 * step), grads[name][place], rel_tol=1e-4, abs_tol=1e-8)
    padded = np.concatenate([network.padding(), network.gates([b"ab", b"cd", b"zz"])])
    fast = network.logits(padded, np.where(real, index + 1, 0), 2)
    assert np.allclose(fast[1], logits, atol=1e-4)
    whole, _ = network.forward(x[index], real, real)
    assert np.allclose(network.logits(padded, np.where(real, index + 1, 0), 9)[0], whole, atol=1e-4)


def test_sliding_sums():
    values = np.random.default_rng(3).random((50, 2))
    for window in (1, 2, 7, 24, 50, 90):
        plain = np.stack([values[i : i + window].sum(axis=0) for i in range(50)])
        assert np.allclose(toxicity.sliding_sums(values, window), plain)


def test_windows_at_every_word():
    sizes = np.array([0, 1, 24, 25, 60, 127, 128, 1000])
    doc, begin, end, first, held = toxicity.runs(sizes)
    for i, size in enumerate(sizes):
        own = [w for r in np.flatnonzero(doc == i) for w in range(first[r], first[r] + held[r])]
        assert own == list(range(max(1, size - toxicity.WINDOW + 1)))
    last = np.minimum(first + held - 1 + toxicity.WINDOW, sizes[doc])
    assert (begin == np.maximum(first - toxicity.CONTEXT, 0)).all()
    assert (end == np.minimum(last + toxicity.CONTEXT, sizes[doc])).all()


def _toxic_network():
    random = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    texts, labels = [], np.arange(400) % 4 == 0
    for toxic in labels:
        text = random.choice(words, int(random.integers(20, 300))).tolist()
        at = int(random.integers(len(text)))
        texts.append(" ".join(text[:at] + [f"bad{i}" for i in range(5)] * int(toxic) + text[at:]))
    return toxicity.train(texts, labels.astype(np.int64), (1.0, 1.0)), words


def test_peaks_equal_single_runs():
    network, words = _toxic_network()
    random = np.random.default_rng(4)
    texts = [[w.encode() for w in random.choice(words, n)] for n in (0, 3, 24, 60, 150, 700)]
    logits, starts = toxicity.Scorer(network).peaks(texts)
    for text, logit, start in zip(texts, logits, starts, strict=True):
        gates = np.concatenate([network.padding(), network.gates(text)]) if text else network.padding()
        index = np.arange(1, len(text) + 1)[None] if text else np.zeros((1, 1), np.int64)
        every = network.logits(gates, index, toxicity.WINDOW)[: max(1, len(text) - 23), 0]
        # Runs read a bounded context, the whole text an unbounded one.
        assert abs(every.max() - logit) < 0.05 and abs(every[start] - logit) < 0.05


def test_passage_scores_alike_at_any_offset():
    network, words = _toxic_network()
    random = np.random.default_rng(5)
    scorer = toxicity.Scorer(network)
    filler = [w.encode() for w in random.choice(words, 400)]
    passage = [b"bad0", b"bad1", b"bad2", b"bad3", b"bad4"]
    clean = scorer.peaks([filler])[0][0]
    found = scorer.peaks([filler[:at] + passage + filler[at:] for at in range(0, 401, 7)])[0]
    assert clean < network.cut < found.min() and found.max() - found.min() < found.min() - clean


def test_long_documents_are_sampled(documents, table, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_CHARS", 400_000)
    rows = [(i, "good words here " * 2000 + ("vile " * (i % 2)), "en", "s") for i in range(20)]
    rows += [(100 + i, "long " * 100_000, "en", "s") for i in range(10)]
    labels = table(
        [(i, i % 2) for i in range(20)] + [(100 + i, 1) for i in range(10)], "doc_id long, toxic int"
    )
    texts, found, weights = toxicity._sample(documents(rows), labels, 5)
    assert 5 < len(texts) and {0, 1} == set(found.tolist()) and min(weights) >= 1
    for label in (0, 1):
        own = [len(t) for t, toxic in zip(texts, found, strict=True) if toxic == label]
        assert 32_000 <= max(own) and sum(own) <= 400_000


def test_toxicity_finds_held_out(documents, table):
    random = np.random.default_rng(1)
    words = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(400):
        text = random.choice(words, int(random.integers(20, 120))).tolist()
        if i % 4 == 0:
            text[int(random.integers(len(text)))] = f"badstem{i % 7}"
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, int(i % 4 == 0), 1))
    found = toxicity.score_toxicity(
        documents(rows), table(labels, "doc_id long, toxic int, quality int")
    ).collect()
    held = [r for r in found if r.held_out]
    assert len(found) == 400 and 0 < len(held) < 400
    right = sum(r.predicted == (r.doc_id % 4 == 0) for r in held)
    assert right / len(held) > 0.95
    assert all(0 <= r.score <= 1 and (r.score >= 0.5) == r.predicted for r in found)


def test_network_is_not_trained_on_the_driver(documents, table, monkeypatch):
    rows = [(i, f"some words {'badstem' * (i % 2)} {i}", "en", "s") for i in range(40)]
    labels = table([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    driver, train = os.getpid(), toxicity.train

    def elsewhere(*sample):
        assert os.getpid() != driver
        return train(*sample)

    monkeypatch.setattr(toxicity, "train", elsewhere)
    assert toxicity.score_toxicity(documents(rows), labels).count() == 40


def test_toxicity_odd_rows(documents, table):
    labels = table([(4, 1), (5, 0), (None, 1), (6, None), (99, 1), (7, 0), (7, 1)], "doc_id long, toxic int")
    assert toxicity.score_toxicity(documents(ODD), labels).count() == len(ODD)
    none = table([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.score_toxicity(documents(ODD), none).collect()} == {0.0}
    carried = toxicity.score_toxicity(documents(ODD), none, carry=True)
    assert carried.select("row.*").count() == len(ODD)
    assert toxicity.score_toxicity(documents([]), labels).count() == 0


# language


def test_language_held_out(sample, rows):
    found = {r.doc_id: r for r in identify_language(sample).collect()}
    held = [r for r in rows if found[r.doc_id].held_out and r.lang]
    right = sum(found[r.doc_id].lang_pred == r.lang for r in held)
    assert right / len(held) > 0.9


def test_language_learns_from_a_large_sample():
    assert language.SAMPLE_DOCUMENTS >= 4000


def test_language_model_is_not_built_on_the_driver(documents, monkeypatch):
    rows = [(i, f"some words {'und' if i % 2 else 'and'} more", "de" if i % 2 else "en", "s") for i in range(40)]
    driver, init = os.getpid(), language.Model.__init__

    def elsewhere(model, found):
        assert os.getpid() != driver
        init(model, found)

    monkeypatch.setattr(language.Model, "__init__", elsewhere)
    found = identify_language(documents(rows)).collect()
    assert [r.lang_pred for r in sorted(found)] == ["en", "de"] * 20


def test_language_odd_rows(documents):
    found = identify_language(documents(ODD)).collect()
    assert len(found) == len(ODD)
    for r in found:
        assert 0 <= r.score <= 1
        if r.doc_id in (1, 2, 3, 4):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in found} <= {"en", "de", "und"}
    nothing = [(i, t, None, s) for i, t, _, s in ODD]
    assert {r.lang_pred for r in identify_language(documents(nothing)).collect()} == {"und"}
    assert identify_language(documents([])).count() == 0


# near duplicates


def components_by_hand(rows, size=5, percent=85):
    sets = []
    for _, text, *_ in rows:
        w = [x.encode().lower() for x in split(text)]
        sets.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    group = list(range(len(rows)))

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                group[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(i)
    out = []
    for own in members.values():
        least = min((rows[i][0] for i in own if rows[i][0] is not None), default=None)
        for i in own:
            out.append((rows[i][0], len(sets[i]), rows[i][0] if not sets[i] else least))
    return sorted(out, key=str)


def edited(random, words, changes):
    copy = list(words)
    for _ in range(changes):
        copy[int(random.integers(len(copy)))] = f"new{int(random.integers(10**9))}"
    return " ".join(copy)


def test_near_duplicates_by_hand(documents):
    random = np.random.default_rng(3)
    rows = []
    for base in range(6):
        words = [f"w{int(x)}" for x in random.integers(0, 500, 80 + 40 * base)]
        for _ in range(40):  # varied copies of one text: a chain of similar ones around it
            rows.append((len(rows), edited(random, words, int(random.integers(0, 6))), "en", "s"))
    rows += [(1000 + i, t, la, s) for i, (_, t, la, s) in enumerate(ODD)]
    rows += [(2000, "Few words", "en", "s"), (2001, "few\tWORDS", "en", "s"), (None, rows[0][1], "en", "s")]
    found = near_duplicates(documents(rows, 3)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == components_by_hand(rows)
    for r in found:
        if r.component_id is not None:
            assert r.kept == (r.doc_id == r.component_id)


def test_near_duplicates_beyond_the_signature_distance(documents, monkeypatch):
    monkeypatch.setattr(near, "bands", lambda percent: 2)
    rows, beyond = [], 0
    for i in range(0, 600, 2):
        words = [f"w{i}x{k}" for k in range(104)]
        texts = [" ".join(words), " ".join([*words[:96], *(f"y{i}x{k}" for k in range(8))])]
        a, b = (near.signature(near.shingle_set(t), 8).reshape(2, 4) for t in texts)
        wrong = (a != b).sum(axis=1)
        if wrong.sum() >= 4 and wrong.min() <= 1:
            beyond += 1
            rows += [(i, texts[0], "en", "s"), (i + 1, texts[1], "en", "s")]
    assert beyond
    found = near_duplicates(documents(rows)).collect()
    assert all(r.component_id == r.doc_id // 2 * 2 for r in found)


def test_near_duplicates_empty(documents):
    assert near_duplicates(documents([])).count() == 0
    found = near_duplicates(documents([(3, None, "en", "s"), (1, "", "en", "s")])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in found) == [(1, 1, True), (3, 3, True)]


def test_near_duplicates_drop_what_earlier_operators_remember():
    tasks = [near._sign(5, 24), near._full_sets(5), near._count_task, near._rarest(np.zeros(1), 85)]
    for task in tasks:  # as in a worker that has run another operator before
        store.remembered("tables of another operator", lambda: bytes(10))
        list(task(iter([])))
        assert not store._MEMORY


def test_near_duplicates_read_few_rows_at_a_time(spark, documents, monkeypatch):
    def watched(make):
        def few(batches):
            for batch in batches:
                if batch.num_rows > 3:
                    raise ValueError(f"{batch.num_rows} rows at a time")
                yield batch

        def made(*args):
            task = make(*args)
            return lambda batches: task(few(batches))

        return made

    monkeypatch.setattr(store, "BATCH_ROWS", 3)
    for name in ("_sign", "_full_sets", "_rarest"):
        monkeypatch.setattr(near, name, watched(getattr(near, name)))
    words = [f"w{k}" for k in range(100)]
    rows = [(i, " ".join([*words, f"end{i}"]), "en", "s") for i in range(20)]
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    found = near_duplicates(documents(rows, 1)).collect()
    assert {r.component_id for r in found} == {0} and len(found) == 20
    assert spark.conf.get(setting) == before
    spark.conf.set(setting, "2")
    with store.small_batches(spark):
        assert spark.conf.get(setting) == "2"
    spark.conf.set(setting, before)


def test_models_come_to_the_driver_without_pickled_rows(documents, table, monkeypatch):
    frame, schemas = type(documents([])), []
    collect = frame.collect

    def watched(self):
        schemas.append(self.schema.simpleString())
        return collect(self)

    monkeypatch.setattr(frame, "collect", watched)
    rows = [(i, ("vile words" if i % 2 else "kind words") + f" w{i}", "en", "s") for i in range(40)]
    labels = table([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    scores = toxicity.score_toxicity(documents(rows), labels)
    found = identify_language(documents(rows))
    assert schemas and not [s for s in schemas if "binary" in s]
    assert len({r.score for r in scores.collect()}) > 1
    assert {r.lang_pred for r in found.collect()} == {"en"}


def test_only_value_of_odd_tables(table):
    big = bytes(range(256)) * 20_000
    assert store.only_value(table([(big,)], "v binary")) == big
    assert store.only_value(table([(None,)], "v binary")) is None
    assert store.only_value(table([], "v binary")) is None


def test_shingle_counts_are_sent_in_the_narrowest_type():
    places = np.array([0, 5, (1 << near.COUNT_BITS) - 1])
    for most in (0, 255, 256, 70_000, 2**40):
        counts = near._table(places, np.array([1, 0, most]))
        assert list(counts[places]) == [1, 0, most] and counts.sum() == 1 + most
    assert not near._table(places[:0], np.empty(0, np.int64)).any()
    sent = cloudpickle.dumps(near._rarest(near._table(places, np.array([1, 2, 60_000])), 80))
    assert len(sent) < 2.5e6


def test_pipeline_sends_python_few_rows_at_a_time(spark, monkeypatch):
    setting, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(setting)

    class Seen(Exception):
        pass

    def watched(*args, **options):
        seen.append(spark.conf.get(setting))
        raise Seen

    monkeypatch.setattr(corpus_pipeline, "table", lambda *args: None)
    steps = {"score_toxicity": "drop_toxic", "identify_language": "drop_unknown_language", "pack": "pack_sequences"}
    try:
        for operator, stage in steps.items():
            spark.conf.set(setting, "10000")
            monkeypatch.setattr(corpus_pipeline, operator, watched)
            with pytest.raises(Seen):
                getattr(corpus_pipeline, stage)(spark, None, SMALL)
    finally:
        spark.conf.set(setting, before)
    assert seen == [str(store.BATCH_ROWS)] * 3


# quality


def statistics_by_hand(text):
    w = split(text)
    counts = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if counts[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if split(x)]
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(documents, rows):
    own = [(r.doc_id, r.text, r.lang, r.source) for r in rows]
    own += [(5000 + i, t, la, s) for i, (_, t, la, s) in enumerate(ODD)]
    own += [(6000, "a b a b a b a b", "en", "s"), (6001, "x\n\nx\n \nx y\nx", "en", "s"), (6002, "& a <b> # " * 30, "en", "s")]
    want = {r[0]: statistics_by_hand(r[1]) for r in own}
    for r in judge_quality(documents(own)).collect():
        n = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        assert n == want[r.doc_id]
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.base_failed and r.kept)


def test_quality_rejects_outliers(documents):
    random = np.random.default_rng(5)
    words = ["alpha", "beta", "of", "the", "gamma", "is", "on", "delta", "ray", "sun"] + [f"word{i}" for i in range(500)]
    rows = []
    for i in range(300):
        text = random.choice(words, int(random.integers(60, 400))).tolist()
        if i % 10 == 0:
            text = [w + "###" for w in text]
        rows.append((i, " ".join(text), "en", "s"))
    found = judge_quality(documents(rows)).collect()
    assert [r.doc_id for r in found if not r.kept and not r.base_failed and r.doc_id % 10] == []
    assert all(not r.kept for r in found if r.doc_id % 10 == 0)
    assert judge_quality(documents([])).count() == 0


# language model


def test_trie_is_a_distribution():
    texts = [b"abracadabra", b"banana", b"", b"abba \xc3\xa9"]
    numbers, _ = ppm.cells(texts)
    levels = []
    for length in range(ppm.ORDER + 1):
        inside = np.uint64((1 << 8 * (length + 1)) - 1)
        found, times = np.unique(numbers & inside, return_counts=True)
        levels.append((found, times))
    trie = ppm.Trie(levels)
    for context in (b"abra", b"\xff\xff\xff\xff", b"xxab", b"zzzz"):
        base = int.from_bytes(context, "big") << 8
        all_symbols = np.arange(256, dtype=np.uint64) + np.uint64(base)
        assert math.isclose((10 ** trie.log_probabilities(all_symbols)).sum(), 1, rel_tol=1e-5)


def ppm_by_hand(train, text):
    """Same model with dictionaries, one byte after the other."""
    counts = defaultdict(Counter)
    for t in train:
        data = b"\xff" * ppm.ORDER + t + b"\xff"
        for i in range(ppm.ORDER, len(data)):
            for length in range(ppm.ORDER + 1):
                counts[data[i - length : i]][data[i]] += 1

    def chances(context):
        if context is None:
            return [1 / 256] * 256
        lower = chances(context[1:] if context else None)
        own = counts.get(context)
        if not own:
            return lower
        total, distinct = sum(own.values()), len(own)
        unseen = 1 - sum(lower[s] for s in own)
        given = 0 if unseen <= 1e-9 else 0.5
        return [
            (own[s] - given) / total if s in own else given * distinct / total * lower[s] / unseen
            for s in range(256)
        ]

    data = b"\xff" * ppm.ORDER + text + b"\xff"
    return sum(math.log10(chances(data[i - ppm.ORDER : i])[data[i]]) for i in range(ppm.ORDER, len(data)))


def test_language_model_by_hand(documents):
    rows = [(i, f"the cat {i % 5} sat on Mat {i % 3} and the dog", "en", "s") for i in range(40)]
    rows += [(100 + i, t[:400] if t else t, la, s) for i, (_, t, la, s) in enumerate(ODD)]
    train = [(r[1] or "").encode().lower() for r in rows if zlib.crc32(str(r[0]).encode()) % 10]
    counts = Counter(w for t in train for w in [*t.split(), b""])
    total, distinct = counts.total(), len(counts)
    found = {r.doc_id: r for r in ppm.score_documents(documents(rows), frequent_words=3).collect()}
    for doc, text, *_ in rows:
        r, data = found[doc], (text or "").encode().lower()
        tokens = [*data.split(), b""]
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (distinct + 1))) for w in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(w in counts for w in tokens), total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9)
        assert math.isclose(r.score, ppm_by_hand(train, data), rel_tol=1e-4)


@pytest.mark.parametrize("deep_cells", [0, 150, 400, 1000])
def test_language_model_whole_beyond_the_cells_sent(documents, deep_cells):
    random = np.random.default_rng(8)
    texts = ["".join(random.choice(list("abcde é"), int(random.integers(5, 40)))) for _ in range(60)]
    train = [t.encode().lower() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 10]
    docs = documents([(i, t, "en", "s") for i, t in enumerate(texts)])
    for r in ppm.score_documents(docs, deep_cells=deep_cells).collect():
        want = ppm_by_hand(train, texts[r.doc_id].encode().lower())
        assert math.isclose(r.score, want, rel_tol=1e-4)


def test_tasks_of_the_language_model_do_not_hold_the_trie(spark):
    numbers = np.arange(200_000, dtype=np.uint64)
    sent = spark.sparkContext.broadcast(ppm.Trie([(numbers, np.ones(len(numbers)))]))
    words = spark.sparkContext.broadcast({})
    for task in (ppm._score_task(sent, words), ppm._level_task(sent, 3), ppm._open_task(sent)):
        assert len(cloudpickle.dumps(task)) < 20_000


def test_language_model_scores_texts_in_little_memory():
    random = np.random.default_rng(4)
    texts = pa.array(["".join(map(chr, random.integers(97, 122, 4000))) for _ in range(500)])
    trie = ppm.Trie([(np.arange(97, 100, dtype=np.uint64), np.ones(3))])
    tracemalloc.start()
    for _, some in ppm._chunks(texts):
        ppm.code_lengths(some, trie)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6


def test_language_model_odd_rows(documents):
    found = ppm.score_documents(documents(ODD)).collect()
    assert len(found) == len(ODD) and all(r.score < 0 for r in found)
    assert ppm.score_documents(documents([])).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    lone = ppm.score_documents(documents([(held, "ab", "en", "s")])).collect()[0]
    assert lone.train_tokens == 0 and math.isclose(lone.score, -3 * math.log10(256), rel_tol=1e-6)


# mixing


def targets_by_hand(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    whole, capped = 1.5 * sum(sizes.values()), {}
    while True:
        left = whole - sum(capped.values())
        weights = sum(weight[s] for s in names if s not in capped)
        goal = {s: left * weight[s] / weights for s in names if s not in capped}
        over = [s for s in goal if goal[s] > 2 * sizes[s]]
        if not over:
            return goal | capped
        capped |= {s: 2 * sizes[s] for s in over}


def test_mixing_reaches_targets(documents, rows):
    own = [(r.doc_id, r.text, r.lang, f"s{r.doc_id % 7}" if r.doc_id % 3 else None) for r in rows]
    docs = documents(own)
    found = {r.doc_id: r for r in mix_report(docs).collect()}
    sizes = Counter()
    for doc, text, _, source in own:
        assert found[doc]["size"] == len(split(text))
        sizes[source] += len(split(text))
    goals = targets_by_hand(sizes)
    taken, largest = Counter(), Counter()
    for doc, text, _, source in own:
        r = found[doc]
        assert math.isclose(r.target, goals[source], rel_tol=1e-9) and r.source_size == sizes[source]
        assert r.taken in (0, r["size"], 2 * r["size"])
        assert r.taken == len(r.shards) * r["size"] and set(r.shards) <= set(range(16))
        taken[source] += r.taken
        largest[source] = max(largest[source], r["size"])
    assert all(abs(taken[s] - goals[s]) <= largest[s] for s in sizes)
    again = {r.doc_id: r for r in mix_report(docs.repartition(5)).collect()}
    assert again == found
    mixed = mix(docs)
    assert mixed.columns == [*docs.columns, "mix_shard", "mix_key"]
    times = Counter(r.doc_id for r in mixed.collect())
    assert all(times[d] == len(found[d].shards) for d in found)


@pytest.mark.parametrize("sources", [7, 50, 5000])
def test_targets_of_sources_that_tie(table, sources):
    sizes = {f"s{i:04}": 160 for i in range(sources)}
    rows = [("=" + s, s, n) for s, n in sizes.items()]
    found = targets(table(rows, "tag string, source string, source_size long").repartition(3)).collect()
    goals = targets_by_hand(sizes)
    assert len(found) == sources
    assert all(math.isclose(r.target, goals[r.tag[1:]], rel_tol=1e-9) for r in found)
    assert math.isclose(sum(r.target for r in found), 1.5 * 160 * sources, rel_tol=1e-9)


def test_mixing_odd_rows(documents):
    found = mix_report(documents(ODD)).collect()
    assert len(found) == len(ODD) and all(r.taken <= 2 * r["size"] for r in found)
    blank = mix_report(documents([(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert [(r.target, r.taken) for r in blank] == [(0.0, 0)] * 2
    assert mix_report(documents([])).count() == 0


def test_words_of_letters_are_given_to_the_model_alone(monkeypatch):
    encoder = WordEncoder(vocabulary_path())
    plain, sent = encoder.tokenizer, []

    class Counting:
        def encode(self, text, **options):
            sent.append(text)
            return plain.encode(text, **options)

        def encode_batch_fast(self, texts, **options):
            sent.extend(texts)
            return plain.encode_batch_fast(texts, **options)

    monkeypatch.setattr(encoder, "tokenizer", Counting())
    text = "Straße, Éléphant! ending###\nStraße 4.5 ending, don't"
    [ids] = encoder.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids
    assert sorted(filter(None, sent)) == ["!", "###", ",", "4.5", "don't"]


def test_word_encoder_of_a_vocabulary_that_keeps_case(tmp_path):
    with open(vocabulary_path()) as file:
        parts = json.load(file)
    path = tmp_path / "cased.json"
    path.write_text(json.dumps({**parts, "normalizer": None}))
    encoder = WordEncoder(str(path))
    text = "Straße, Éléphant! STRASSE ending"
    [ids] = encoder.encode([text])
    assert not encoder.direct
    assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_word_encoder_agrees_with_the_tokenizer():
    encoder = WordEncoder(vocabulary_path())
    texts = [
        "", " ", "Don't!! I'LL go's", "İ H̱ ẞ ß Straße ÀÉ.,; ́x", "a\r\n\tfoo bar",
        "<|endoftext|> x<|startoftext|>. B", "a" * 5000 + "! b", "b!! " * 90, "42 4.5 a1 ÿ× ªº µ",
    ]
    texts.append(" ".join(f"{a}{b}{c}" for a in "aÄé" for b in "xyZñ" for c in "klmo") * 40)
    for _ in range(2):
        got = encoder.encode(texts)
        for text, ids in zip(texts, got, strict=True):
            plain = encoder.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == plain
    assert max(map(len, encoder.known)) <= packing.REMEMBERED_CHARS
