"""Toxicity network, periodic runs and whitening against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm import gru_toxicity, periodic_runs, qd_whitening
from touchline.llm.queries import queries

LABELLED = "/root/testdata/sf0.1"

# --- 11 toxicity


@pytest.fixture(scope="module")
def network(spark):
    return gru_toxicity.train(spark.read.parquet(f"{LABELLED}/documents.parquet"), spark.read.parquet(f"{LABELLED}/labels.parquet"))


def test_gradients_equal_differences(monkeypatch):
    monkeypatch.setattr(gru_toxicity, "F32", np.float64)
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(9)] + ["ab", "réeux"]
    net = gru_toxicity.Network.fresh({w: i + 1 for i, w in enumerate(words[:7])})
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    at = rng.integers(0, len(words), (5, 6))
    at[1, 4:] = at[3] = -1
    first, y = np.array([0, 2, 3]), np.array([1.0, 0.0, 1.0])

    def loss():
        x, _ = net.inputs([*words, ""])
        x[-1] = 0
        real = (at >= 0) | (at < 0).all(1)[:, None]
        odds, _ = net.attend(net.run(net.projected(x), at).astype(np.float64), real)
        d, _ = gru_toxicity.smooth_maximum(odds, first)
        return np.mean(np.logaddexp(0, d) - y * d)

    grown = gru_toxicity._gradients(net, words, at, first, y)
    for name, w in net.weights.items():
        i = int(np.abs(grown[name]).argmax())
        flat, old, e = w.reshape(-1), w.reshape(-1)[i], 1e-3
        flat[i] = old + e
        up = loss()
        flat[i] = old - e
        down = loss()
        flat[i] = old
        assert (up - down) / (2 * e) == pytest.approx(grown[name].ravel()[i], rel=2e-2), name


def test_toxicity_on_held_out_rows(spark, network):
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    unseen = docs.join(labels.where(gru_toxicity.held_out(F.col("doc_id"))), "doc_id")
    got = gru_toxicity.score(unseen, network).join(labels, "doc_id").toPandas()
    assert len(got) > 700
    assert ((got.score >= 0.5) == (got.toxic == 1)).mean() > 0.96
    high, low = got.score[got.toxic == 1].to_numpy(), got.score[got.toxic == 0].to_numpy()
    assert (high[:, None] > low[None, :]).mean() > 0.95
    assert (low >= 0.5).mean() < 0.02 and (high >= 0.5).mean() > 0.85


def test_toxicity_scores_odd_rows(spark, odd_docs, no_docs, network):
    rows = gru_toxicity.score(odd_docs, network).collect()
    assert len(rows) == 8 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert gru_toxicity.score(no_docs, network).count() == 0
    labels = spark.read.parquet(f"{LABELLED}/labels.parquet")
    docs = spark.read.parquet(f"{LABELLED}/documents.parquet")
    none = gru_toxicity.train(docs, labels.limit(0))
    assert {r.score for r in gru_toxicity.score(odd_docs, none).collect()} == {0.0}
    one = gru_toxicity.train(docs, labels.where("toxic = 1"), max_documents=5)
    assert {r.score for r in gru_toxicity.score(odd_docs, one).collect()} == {1.0}


def test_every_window_is_scored_whatever_the_pieces(network, monkeypatch):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["idiot", "the", "thé", "über", "x1"]) for _ in range(n)) for n in (0, 1, 16, 47, 48, 49, 80, 81, 400, 1000)]
    for text in texts:
        words = [w for piece in gru_toxicity.words_of(text) for w in piece]
        starts = gru_toxicity.window_starts(len(words))
        covered = {i for a in starts.tolist() for i in range(a, min(a + gru_toxicity.WINDOW, len(words)))}
        assert covered == set(range(len(words)))
    whole = gru_toxicity.Scorer(network).odds(texts)
    monkeypatch.setattr(gru_toxicity, "PIECE_CHARS", 90)
    monkeypatch.setattr(gru_toxicity, "CACHE_WORDS", 3)
    monkeypatch.setattr(gru_toxicity, "BATCH_WINDOWS", 3)
    assert gru_toxicity.Scorer(network).odds(texts) == pytest.approx(whole, abs=1e-3)


# --- 12 periodic runs


def brute_runs(w):
    found = set()
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(6, 4 * q):
                part = w[i : i + length]
                if all(any(part[x] != part[x + r] for x in range(length - r)) for r in range(1, q)):
                    found.add((i, length, q))
            i = max(j, i) + 1 if j == i else j
    return sorted(found, key=lambda x: (x[0], x[2]))


def test_runs_equal_brute_force():
    rng = random.Random(5)
    for _ in range(400):
        docs = []
        for _ in range(rng.randint(1, 4)):
            n, k = rng.randint(0, 60), rng.choice([1, 2, 2, 3, 5])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a, p = rng.randrange(n), rng.randint(1, 12)
                w = [w[i] if i < a else w[min(a + (i - a) % p, n - 1)] for i in range(n)]
            docs.append(np.array(w, np.int32))
        of, start, length, period = periodic_runs.find_runs(docs)
        for k, w in enumerate(docs):
            mine = of == k
            assert list(zip(start[mine].tolist(), length[mine].tolist(), period[mine].tolist(), strict=True)) == brute_runs(w.tolist())


def plain_row(doc_id, text):
    """The contract, word for word."""
    words = [w for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    drop = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda b: hashlib.sha256(b).hexdigest()
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2], sha(listed), sha(b" ".join(w for i, w in enumerate(words) if i not in drop)))


def test_runs_query_equals_the_contract(spark, odd_docs, no_docs, tmp_path):
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice("ab c é".split()) for _ in range(rng.randint(0, 90)))) for i in range(150)]
    rows += [(3, "x y x\u0085y\tx\u0085y " * 9), (4, "ha " * 5), (4, "ha " * 6), (4, "ha " * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit(1), "start": F.lit("s")})
    docs = docs.unionByName(odd_docs.where("doc_id is null or doc_id <> 4").select("doc_id", "text"), allowMissingColumns=True)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries()["op12_periodic_runs"](spark, str(tmp_path)).drop("n_words").collect()
    want = [plain_row(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(r.n_runs > 1 for r in got)
    assert periodic_runs.periodic_runs(no_docs).count() == 0
    long = " ".join(["a", "b"] * 300_000)
    row = periodic_runs.periodic_runs(spark.createDataFrame([(1, long)], "doc_id long, text string")).first()
    assert (row.n_runs, row.start, row.length, row.period, row.collapsed) == (1, 0, 600_000, 2, "a b")


# --- 13 whitening


def solved(x):
    n, d = x.shape
    sums = np.array([int(s) for s in x.sum(0)], object)
    r = np.linalg.qr(qd_whitening._centred(x, n, sums), mode="r")
    full = np.zeros((d, d))
    full[: len(r)] = r
    return qd_whitening.solve(full, n, sums)


@pytest.mark.parametrize("kind", ["gauss", "scaled", "few", "equal", "hadamard", "bits", "one", "flat"])
def test_solver_equals_eigenvalues(kind):
    rng = np.random.default_rng(3)
    h = np.array([[1.0]])
    for _ in range(4):
        h = np.block([[h, h], [h, -h]])
    a = {
        "gauss": rng.standard_normal((500, 40)),
        "scaled": rng.standard_normal((300, 20)) * np.logspace(0, 5, 20),
        "few": rng.standard_normal((9, 30)),
        "equal": np.vstack([np.eye(20), -np.eye(20)]),
        "hadamard": np.vstack([h, -h]),
        "bits": rng.integers(0, 2, (400, 8)).astype(float),
        "one": rng.standard_normal((50, 1)),
        "flat": np.hstack([rng.standard_normal((60, 4)), np.ones((60, 3))]),
    }[kind]
    x = np.unique(np.floor(64 * a).astype(np.int64) + 1_000_000, axis=0)
    model = solved(x)
    c = x - x.mean(0)
    v = c.T @ c / len(x)
    want = np.linalg.svd(c, compute_uv=False) ** 2 / len(x)  # an eigenvalue routine loses graded values
    k = len(model.eigenvalues)
    assert k == int((want > want[0] * 1e-12).sum())
    assert model.eigenvalues == pytest.approx(want[:k], rel=1e-9)
    assert np.abs(v @ model.components - model.components * model.eigenvalues).max() < 1e-10 * want[0]
    w = model.whiten(x)
    assert np.abs(w.T @ w / len(x) - np.eye(k)).max() < 1e-8
    s = x.sum(0)
    exact = [sum((len(x) * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for row in x.tolist()]
    assert model.deviation(x) == [e if e < 1 << 63 else None for e in exact]


def test_singular_values_of_graded_bidiagonals_are_relatively_accurate():
    # diag falls by 1e12: values known from the product form of a 2 x 2 at each end
    a, b = np.array([1e6, 1.0, 1e-6]), np.array([1e-3, 1e-9])
    got = np.sqrt(qd_whitening.squared_values(a, b))
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    det = Decimal(1)
    for x in a:
        det *= Decimal(float(x))
    product = Decimal(1)
    for x in got:
        product *= Decimal(float(x))
    assert abs(product / det - 1) < Decimal("1e-13")


def test_whitening_query(spark, tmp_path, monkeypatch):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((300, 18)).astype(np.float32)
    rows = [(i, x.tolist(), "a") for i, x in enumerate(v)]
    rows += [(0, v[5].tolist(), "b"), (7, v[7].tolist(), "b"), (7, v[7].tolist(), "b"), (None, v[9].tolist(), "n")]
    rows += [(900, None, ""), (901, [float("nan")] * 18, ""), (902, [float("inf")] * 18, ""), (903, [None] * 18, ""), (904, [], ""), (905, [0.0] * 18, ""), (906, [1.0, 2.0], ""), (907, [2.0, 2.0], ""), (908, [0.5, 1.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, n string").withColumn("x", F.lit(1))
    df.repartition(80).write.parquet(f"{tmp_path}/embeddings.parquet")
    monkeypatch.setattr(qd_whitening, "FAN_IN", 4)  # several reduction rounds
    got = queries()["op13_qd_whitening"](spark, str(tmp_path)).toPandas()
    long = [r for r in rows if r[1] and len(r[1]) == 18 and all(c is not None and np.isfinite(c) for c in r[1])]
    x = np.floor(64 * np.array([r[1] for r in long], np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - s / n
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:16], u[:, ::-1][:, :16]
    assert got.identity_error.max() == got.identity_error.min() < 1e-9
    mine = got[got.n == n]
    assert len(mine) == 16 * len(long) and set(got.n) == {n, 3}
    of = {}
    for r in mine.itertuples():
        of.setdefault((r.vec_id if r.vec_id == r.vec_id else None, r.deviation), {})[r.component] = (r.whitened, r.explained)
    want = (x - s / n) @ u / np.sqrt(e)
    sign = None
    for i, r in enumerate(long):
        have = of[(r[0], int(((n * x[i] - s) ** 2).sum()))]
        w = np.array([have[k + 1][0] for k in range(16)])
        if sign is None:
            sign = np.sign(w * want[i])
        assert w == pytest.approx(sign * want[i], abs=1e-8)
        assert [have[k + 1][1] for k in range(16)] == pytest.approx(e / np.trace(cov), rel=1e-9)
    assert qd_whitening.whiten(qd_whitening.grid(df.limit(0)), {}).count() == 0
    models, _ = qd_whitening.fit_whitening(qd_whitening.grid(df.limit(0)))
    assert models == {}
    one, fit_list = qd_whitening.fit_whitening(qd_whitening.grid(df.where("vec_id = 7")))
    assert fit_list.count() == 1 and qd_whitening.whiten(qd_whitening.grid(df), one).count() == 0
