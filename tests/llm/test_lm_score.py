"""Language-model scores: the base against plain counting, the model against its own definition."""

import math
import pickle
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventtally.llm import lm_score
from eventtally.llm.lm_score import (
    CLASSES,
    FINE_IDS,
    FINE_LAST,
    IdTables,
    Model,
    TextIds,
    long_score,
    op4_attention_scores,
    score_texts,
    scores_of,
    window_rows,
    windows,
)
from eventtally.llm.subwords import default_path

SF = "/root/testdata/sf0.001"
IDS = 9000


@pytest.fixture(scope="module")
def fitted():
    rng = np.random.default_rng(1)
    counts = np.floor(rng.pareto(1, IDS) * 5)
    tables = IdTables(counts)
    pairs = np.zeros((CLASSES + 2) * IDS + FINE_LAST * FINE_IDS)
    pairs[rng.integers(0, len(pairs), 50_000)] = rng.integers(1, 9, 50_000)
    tables.learn_shares(pairs, 30)
    model = Model(tables.prior)
    for part in model.parts.values():
        part += rng.normal(0, 0.3, part.shape).astype(np.float32)
    return tables, model, rng


def test_probabilities_of_all_ids_sum_to_one(fitted):
    tables, model, rng = fitted
    for last in (int(tables.order[3]), int(tables.order[2000]), int(tables.order[8000]), tables.end):
        before = np.append(rng.integers(0, IDS, 20), last)
        ids = np.arange(IDS)
        # The class weights of one context, then the shares of all ids after it.
        keys, *_ = window_rows(np.append(before, 0), np.array([len(before) + 1]), tables)
        at = len(before) % lm_score.STRIDE
        attended = model.attend(keys[-1:])
        state = np.repeat(attended["state"][:, at], CLASSES, axis=0)
        rows = np.repeat(attended["own_rows"][:, at], CLASSES)
        logs = model.class_logs(state, rows, np.arange(CLASSES))[0]
        assert math.isclose(np.exp(logs.astype(float)).sum(), 1, rel_tol=1e-4)
        shares = np.exp(tables.log_shares(np.full(IDS, last), ids).astype(float))
        assert np.allclose(np.bincount(tables.classes, shares, CLASSES), 1, rtol=1e-3)


def test_windows_score_each_id_once():
    lengths = np.array([1, 16, 17, 40, 5])
    keys, queries, document = windows(lengths)
    real = queries[queries >= 0]
    assert sorted(real.tolist()) == list(range(lengths.sum()))
    starts = np.cumsum(lengths) - lengths
    for row, doc in zip(keys, document):
        inside = row[row >= 0]
        assert (inside >= starts[doc]).all() and (inside < starts[doc] + lengths[doc]).all()


def test_no_id_sees_what_follows(fitted):
    tables, model, rng = fitted
    ids = rng.integers(0, IDS, 70)
    one, _, _, real, _ = window_rows(ids, np.array([70]), tables)
    changed = ids.copy()
    changed[40:] = rng.integers(0, IDS, 30)
    other, *_ = window_rows(changed, np.array([70]), tables)
    state = [model.attend(k)["state"].reshape(-1, lm_score.HIDDEN)[real.ravel()] for k in (one, other)]
    # The state of place k is made of the ids before k.
    assert np.allclose(state[0][:41], state[1][:41], atol=1e-5)
    assert not np.allclose(state[0][41:], state[1][41:], atol=1e-5)


def test_documents_do_not_see_one_another_and_long_ones_are_cut_right(fitted, monkeypatch):
    tables, model, rng = fitted
    parts = [rng.integers(0, IDS, n) for n in (3, 100, 1, 333)]
    alone = [scores_of(p, np.array([len(p)]), tables, model)[0] for p in parts]
    together = scores_of(np.concatenate(parts), np.array([len(p) for p in parts]), tables, model)
    assert np.allclose(alone, together, rtol=1e-5)
    monkeypatch.setattr(lm_score, "SCORE_IDS", 64)
    assert math.isclose(long_score(parts[3], tables, model), alone[3], rel_tol=1e-5)


def test_slopes_equal_differences(fitted):
    tables, _, rng = fitted
    model = Model(tables.prior)
    ids = rng.integers(0, IDS, 60)
    keys, targets, _, real, _ = window_rows(ids, np.array([25, 35]), tables)
    loss = lambda: model.gradients(keys, tables.classes[targets], real)
    _, slopes = loss()
    for name in ("out", "bias", "distance", "own", "value", "query", "key"):
        at = np.unravel_index(np.argmax(np.abs(slopes[name])), slopes[name].shape)
        values = []
        for step in (0.02, -0.02):
            model.parts[name][at] += step
            values.append(loss()[0])
            model.parts[name][at] -= step
        assert math.isclose((values[0] - values[1]) / 0.04, slopes[name][at], rel_tol=0.1, abs_tol=1e-5)


def test_training_lowers_the_loss(fitted, monkeypatch):
    tables, _, rng = fitted
    monkeypatch.setattr(lm_score, "STEPS", 60)
    ids = np.tile(rng.integers(0, IDS, 50), 40)
    keys, targets, _, real, _ = window_rows(ids, np.array([len(ids)]), tables)
    losses = Model(tables.prior).fit(keys, tables.classes[targets], real)
    assert np.mean(losses[-5:]) < 0.5 * losses[0]


def test_common_words_are_looked_up_alike():
    words = [b"the", b"caf\xc3\xa9", b"<|endoftext|>", b"a1!", b"the"]
    plain = TextIds(default_path())
    known = {w: plain.of_word(w) for w in (b"the", b"a1!")}
    assert TextIds(default_path(), known).of_words(words) == plain.of_words(words)
    assert plain.of_words([b"a", b"b"]) == plain.of_word(b"a") + plain.of_word(b"b") + plain.end


def plain_base(rows, learnt):
    counts, documents = Counter(), 0
    split = lambda t: (t or "").encode().lower().split()
    for doc_id, text in rows:
        if learnt(doc_id):
            counts.update(split(text))
            documents += 1
    total, types = sum(counts.values()) + documents, len(counts) + (documents > 0)
    out = []
    for doc_id, text in rows:
        ns = [counts[w] for w in split(text)] + [documents]
        out.append((doc_id, len(ns), sum(n > 0 for n in ns), total, sum(math.log10((n + 1) / (total + types + 1)) for n in ns)))
    return sorted(out, key=str)


def assert_base(found, want):
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=str)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_query(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 20)
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    crc = lambda d: zlib.crc32(str(d).encode()) % 7
    found = op4_attention_scores(spark, SF).collect()
    assert_base(found, plain_base(rows, lambda d: crc(d) != 2))
    assert all(r["held_out"] == (crc(r["doc_id"]) == 2) for r in found)


def test_edge_rows(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 5)
    few = lambda words, documents: VOCABULARY(words, documents, 2)
    monkeypatch.setattr(lm_score, "vocabulary", few)
    rows = [(1, None), (2, ""), (3, "a b a É"), (4, "A  zz unseen\tw"), (4, "a b"), (None, "a q"), (5, "x " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as `row`", "'n' as n", "2 as score")
    learning = F.coalesce(F.col("doc_id") < 4, F.lit(False))
    found = score_texts(docs, learning).collect()
    assert_base(found, plain_base(rows, lambda d: d is not None and d < 4))
    nothing = score_texts(docs, F.lit(False)).collect()
    assert all(r["base_score"] == 0 and r["n_known"] == 0 for r in nothing)
    assert score_texts(docs.limit(0), learning).count() == 0


def test_pairs_across_words_are_counted_over_all_texts(spark, monkeypatch):
    path = default_path()
    texts = ["red fox", "Red fox blue", "", None, "qzxv red"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tables = IdTables(np.arange(lm_score.subwords(path).size + 1, dtype=float))
    encode = TextIds(path)
    ids = lambda w: np.frombuffer(encode.of_word(w), np.uint32).tolist()
    want = Counter()
    for text in texts:
        edges = [(tables.end, tables.end)] + [(ids(w)[0], ids(w)[-1]) for w in (text or "").encode().lower().split()]
        want.update((a[1], b[0]) for a, b in zip(edges, edges[1:] + edges[:1]))
    known = {b"red": encode.of_word(b"red")}
    counts = lm_score.counted_across(docs, path, tables, known)
    coarse = counts[: CLASSES * len(tables.classes)].reshape(CLASSES, -1)
    by_class = Counter()
    for (a, b), n in want.items():
        by_class[int(tables.classes[a]), b] += n
    assert {k: coarse[k] for k in by_class} == by_class and coarse.sum() == sum(want.values())
    fine = counts[CLASSES * len(tables.classes) :].reshape(FINE_LAST, FINE_IDS)
    low = {(a, b): n for (a, b), n in want.items() if tables.rank[a] < FINE_LAST and tables.rank[b] < FINE_IDS}
    assert low and fine.sum() == sum(low.values())
    assert all(fine[tables.rank[a], tables.rank[b]] == n for (a, b), n in low.items())


def test_the_order_of_words_counts_without_any_fitting(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 1)
    rows = [(k, "red fox blue whale " * 50) for k in range(30)]
    rows += [(98, "red fox blue whale red fox"), (99, "red blue red whale fox fox")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in score_texts(docs, F.col("doc_id") < 98).collect()}
    assert found[98]["base_score"] == pytest.approx(found[99]["base_score"])
    assert found[98]["score"] > found[99]["score"] + 2


def test_weights_learn_from_whole_distinct_texts_that_grow_with_the_corpus(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LEAST_TEXTS", 10)
    monkeypatch.setattr(lm_score, "LEAST_CHARS", 10)
    long = "word " * 40_000
    for texts, share in ((400, 1 / 16), (4000, 1 / 16), (8, 1)):
        rows = [(f"{long if k == 0 else ''}text number {k % texts}",) for k in range(2 * texts)]
        docs = spark.createDataFrame(rows, "text string").repartition(3)
        found = [r["ids"] for r in lm_score.learning_ids(docs, default_path(), {}).collect()]
        assert len(found) == len(set(found))
        assert 0.5 * share * texts < len(found) < 2 * share * texts + 2
        encode = TextIds(default_path())
        whole = {encode.of_words(t.encode().split()) for (t,) in rows}
        assert {bytes(f) for f in found} <= whole


def test_weights_learn_from_every_text_of_a_corpus_that_is_not_small(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LEAST_TEXTS", 1)
    monkeypatch.setattr(lm_score, "LEAST_CHARS", 1)
    seen = []
    monkeypatch.setattr(lm_score, "fitted_round", lambda texts, *_: seen.append([bytes(r["ids"]) for r in texts.collect()]))
    texts = [f"text number {k}" for k in range(400)] + ["", None, "text number 3"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    tables = SimpleNamespace(rows=None, classes=None, end=0, prior=np.zeros((lm_score.PAD_ROW + 1, CLASSES)))
    lm_score.trained(docs, tables, default_path(), {})
    encode = TextIds(default_path())
    assert Counter(seen[-1]) == Counter(encode.of_words((t or "").encode().split()) for t in texts)


def test_a_round_over_all_texts_takes_every_window_once(spark, fitted):
    tables, _, rng = fitted
    small = SimpleNamespace(rows=tables.rows, classes=tables.classes, end=tables.end)
    model = Model(tables.prior)
    before = model.numbers()
    ids = [rng.integers(0, IDS, 5000).astype(np.uint32).tobytes() for _ in range(4)]
    texts = spark.createDataFrame([(bytearray(i),) for i in ids], "ids binary").coalesce(1)
    assert lm_score.fitted_round(texts, small, model, 0.01, 0)
    assert not np.allclose(model.numbers(), before)
    (pool,) = lm_score.pools_of(iter(ids), small)
    alone = Model(tables.prior)
    alone.fit(*pool, seed=0, steps=-(-len(pool[0]) // lm_score.BATCH_WINDOWS), rate=0.01)
    assert np.allclose(alone.numbers(), model.numbers(), atol=1e-3)


def test_long_texts_are_learned_from_to_their_end(fitted, monkeypatch):
    tables, _, rng = fitted
    ids = rng.integers(0, IDS, 1000)
    monkeypatch.setattr(lm_score, "SCORE_IDS", 64)
    monkeypatch.setattr(lm_score, "POOL_WINDOWS", 20)
    pools = list(lm_score.pools_of(iter([ids.astype(np.uint32).tobytes()] * 2), tables))
    assert len(pools) > 1
    keys, targets, _, real, _ = window_rows(np.tile(ids, 2), np.array([1000, 1000]), tables)
    for at, whole in enumerate((keys, tables.classes[targets], real)):
        assert np.array_equal(np.concatenate([p[at] for p in pools]), whole)


def test_only_few_words_are_collected(spark):
    words = spark.createDataFrame([(f"w{k}", 1 + k // 10) for k in range(200)], "word string, n long")
    for most in (0, 5, 50, 500):
        found = VOCABULARY(words, 3, most).frequent
        assert len(found) <= most and (most < 50 or len(found) >= most // 4 or len(found) == 200)
        others = [1 + k // 10 for k in range(200) if f"w{k}".encode() not in found]
        assert all(n >= max(others, default=0) for n in found.values())


VOCABULARY = lm_score.vocabulary


def test_the_model_is_better_than_the_unigram_on_held_out_documents(spark):
    found = op4_attention_scores(spark, "/root/testdata/sf0.1").filter("held_out")
    sums = found.agg(F.sum("base_score").alias("base"), F.sum("score").alias("score"), F.sum("n_tokens").alias("n"))
    row = sums.first()
    assert row["score"] / row["n"] > row["base"] / row["n"] + 0.05


def test_no_task_encodes_and_learns_in_two_python_workers(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LEAST_TEXTS", 1)
    monkeypatch.setattr(lm_score, "LEAST_CHARS", 1)
    plans = []
    monkeypatch.setattr(
        lm_score, "fitted_round", lambda texts, *_: plans.append(texts._jdf.queryExecution().executedPlan().toString())
    )
    docs = spark.createDataFrame([(f"text number {k}",) for k in range(400)], "text string")
    tables = SimpleNamespace(rows=None, classes=None, end=0, prior=np.zeros((lm_score.PAD_ROW + 1, CLASSES)))
    lm_score.trained(docs, tables, default_path(), {})
    assert plans and not any("MapInArrow" in plan for plan in plans)


def test_what_tasks_look_up_is_sent_once_and_not_with_every_task(spark):
    known = {f"w{k}".encode(): bytes(4) for k in range(9)}
    docs = spark.createDataFrame([("w1 w2",)], "text string")
    held = lm_score.sent(docs, known)
    assert lm_score.sent(docs, held) is held and held.value == known
    (row,) = lm_score.encoded(docs.selectExpr("1L as number", "text"), default_path(), held).collect()
    assert bytes(row["ids"])[:8] == bytes(8)


def test_the_tasks_of_a_round_follow_its_windows_and_not_the_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "LEAST_TEXTS", 1)
    monkeypatch.setattr(lm_score, "LEAST_CHARS", 1)
    seen = []
    monkeypatch.setattr(lm_score, "fitted_round", lambda texts, *_: seen.append(texts.rdd.getNumPartitions()))
    small = {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1k"}
    docs = spark.createDataFrame([(f"text number {k}",) for k in range(400)], "text string").repartition(40)
    tables = SimpleNamespace(rows=None, classes=None, end=0, prior=np.zeros((lm_score.PAD_ROW + 1, CLASSES)))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        lm_score.trained(docs, tables, default_path(), {})
        most = spark.sparkContext.defaultParallelism
        assert len(seen) == lm_score.ROUNDS + 1 and max(seen) <= most
        monkeypatch.setattr(lm_score, "TASK_WINDOWS", 40)
        lm_score.trained(docs, tables, default_path(), {})
        assert seen[-1] == 10
    finally:
        for key in small:
            spark.conf.unset(key)


def test_pairs_of_stored_ids_are_those_within_and_across_words(spark):
    path = default_path()
    texts = ["red fox", "Red fox blue fox", "", None, "qzxv red", "qzxv " * 50]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    tables = IdTables(np.arange(lm_score.subwords(path).size + 1, dtype=float))
    words = lm_score.counted_words(docs)
    corpus = lm_score.vocabulary(words, len(texts), 2)
    encode = TextIds(path)
    known = {w: encode.of_word(w) for w in corpus.frequent}
    stored = lm_score.with_ids(docs, F.col("doc_id") >= 0, path, corpus, known)
    found = lm_score.counted_pairs(stored, tables)
    within = lm_score.counted_ids(words, path, tables)
    width = len(tables.classes)
    want = lm_score.counted_across(docs, path, tables, known)
    want[: CLASSES * width] += within[: CLASSES * width]
    want[CLASSES * width :] += within[(CLASSES + 2) * width :]
    assert found.sum() > 0 and np.array_equal(found, want)


def test_each_text_is_encoded_once(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "STEPS", 5)
    monkeypatch.setattr(lm_score, "LEAST_TEXTS", 1)
    monkeypatch.setattr(lm_score, "LEAST_CHARS", 1)
    rounds, encoded = [], []
    fitted, encode = lm_score.fitted_round, lm_score.encoded
    monkeypatch.setattr(lm_score, "fitted_round", lambda texts, *a: rounds.append(texts.count()) or fitted(texts, *a))
    monkeypatch.setattr(lm_score, "encoded", lambda texts, *a: encoded.append(texts.count()) or encode(texts, *a))
    docs = spark.createDataFrame([(k, f"text number {k}") for k in range(400)], "doc_id long, text string")
    found = score_texts(docs, F.col("doc_id") < 300)
    assert found.count() == 400
    # The first rounds encode their share; the last one takes every learning text as it is stored.
    assert rounds[-1] == 300 and encoded and max(encoded) < 100


def test_fitting_is_adam_and_hands_on_the_same_numbers(fitted):
    tables, _, rng = fitted
    model = Model(tables.prior)
    ids = rng.integers(0, IDS, 300)
    keys, targets, _, real, _ = window_rows(ids, np.array([300]), tables)
    batch = keys, tables.classes[targets], real
    want = {name: part.astype(float) for name, part in model.parts.items()}
    first, second = ({name: np.zeros_like(part) for name, part in want.items()} for _ in range(2))
    for step in range(1, 4):
        for name, slope in model.gradients(*batch)[1].items():
            first[name] += 0.1 * (slope - first[name])
            second[name] += 0.01 * (slope.astype(float) ** 2 - second[name])
            root = np.sqrt(second[name] / (1 - 0.99**step)) + 1e-8
            want[name] -= 0.001 * first[name] / (1 - 0.9**step) / root
        handed_on = pickle.loads(pickle.dumps(model))
        handed_on.fit(*batch, steps=1, rate=0.001)
        model.fit(*batch, steps=1, rate=0.001)
        assert np.array_equal(handed_on.numbers(), model.numbers())
        for name, part in model.parts.items():
            assert np.allclose(part, want[name], atol=2e-5)


def test_pools_end_with_the_texts_that_fill_them(fitted, monkeypatch):
    tables, _, rng = fitted
    monkeypatch.setattr(lm_score, "SCORE_IDS", 640)
    monkeypatch.setattr(lm_score, "POOL_WINDOWS", 30)
    sizes = [100, 1, 300, 17, 200, 1000, 16, 640, 5]
    parts = [rng.integers(0, IDS, n) for n in sizes]
    pools = list(lm_score.pools_of((p.astype(np.uint32).tobytes() for p in parts), tables))
    # Windows of the texts: 7, 1, 19, 2, 13, 40 and 23 (a long text is cut), 1, 40, 1.
    assert [len(p[0]) for p in pools] == [42, 40, 64, 1]
    keys, targets, _, real, _ = window_rows(np.concatenate(parts), np.array(sizes), tables)
    for at, whole in enumerate((keys, tables.classes[targets], real)):
        assert np.array_equal(np.concatenate([p[at] for p in pools]), whole)
