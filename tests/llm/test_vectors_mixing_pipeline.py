import itertools
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrasieve.llm import ann, common, mixing

SF = "/root/testdata/sf0.001"


def brute_nearest(rows, k=5):
    usable = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 16 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    usable = list({(i, v.tobytes()): (i, v) for i, v in usable}.values())
    unit = np.array([v / np.linalg.norm(v) for _, v in usable])
    ids = np.array([i for i, _ in usable])
    out = {}
    for at, (i, _) in enumerate(usable):
        if i % 10 == 0:
            score = unit @ unit[at]
            order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), score[j]) for j in order]
    return out


def test_nearest(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=16) + 3 * (i % 4 == np.arange(16) % 4)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]  # one vector in many rows
    rows += [(2000, None), (2010, [0.0] * 16), (2020, [float("nan")] + [1.0] * 15), (2030, [1.0] * 3), (None, rows[3][1]), (rows[5][0], rows[5][1]), (2040, [None] + [1.0] * 15)]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], "vec_id long, embedding array<float>, id string")
    got = {}
    for r in ann.search(df, F.col("row") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = brute_nearest(rows)
    assert set(got) == set(want) and all(len(v) == 5 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 5 * len(want)
    assert got[1000] == [(7, pytest.approx(1.0)), *[(1000 + i, pytest.approx(1.0)) for i in range(1, 5)]]
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in rows[:460]}
    assert all(abs(s - unit[q] @ unit[i]) < 1e-12 for q, near in got.items() for i, s in near)
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.1])], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.search(few, F.col("row") == 0).orderBy("rank").collect()] == [1, 2]
    assert ann.search(few.limit(0), F.col("row") == 0).count() == 0
    assert ann.search(few.limit(1), F.col("row") == 0).count() == 0


def brute_mix(p, goal, rounds=20_000):
    """Least squares over rates in [0, 1] by plain projected gradient on the whole matrix."""
    weigh = np.linalg.pinv(p.T @ (p / np.maximum(p.sum(1), 1)[:, None]))
    rate = np.ones(len(p))
    share = p / np.maximum(p.sum(1), 1)[:, None]
    for _ in range(rounds):
        step = share @ (weigh @ (rate @ p - goal))
        rate, old = np.clip(rate - step, 0, 1), rate
        if np.abs(rate - old).max() < 1e-9:
            break
    return rate


def brute_posteriors(text, model):
    words = [w for w in (text or "").lower().replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if w]
    import re

    import xxhash

    odd = len(re.sub(r"""[^\W_]|[\s.,;:?'"()-]""", "", text or ""))
    n = len(words)
    marks = {*words, f"\tdistinct {min(10 * len(set(words)) // max(n, 1), 10)}", f"\tsigns {min(10 * odd // max(n, 1), 20)}"} & set(model.vocabulary)
    odds = []
    for d in mixing.DOMAINS:
        total = model.base[d]
        for w in marks:
            h = xxhash.xxh64_intdigest(w.encode(), 42)
            total += model.weights[d][h >> model.shifts[h & (mixing.BUCKETS - 1)] & (model.places - 1)]
        odds.append(total)
    e = np.exp(np.array(odds) - max(odds))
    return n, e / e.sum()


def test_posteriors_against_brute_force(spark, docs):
    table = common.read_table(spark, SF, "documents")
    model = mixing.fit_classifier(table, common.read_table(spark, SF, "labels"))
    assert len(set(mixing._laid_out(np.random.default_rng(0).integers(-(2**63), 2**63, 500).tolist())[2])) == 500
    both = table.select("doc_id", "text").unionByName(docs.select("doc_id", "text")).withColumn("key", F.monotonically_increasing_id())
    rows = both.select(F.col("key").alias("doc_id"), "text")
    got = {r.doc_id: r for r in mixing.posteriors(rows, model).collect()}
    for r in rows.collect():
        n, p = brute_posteriors(r.text, model)
        assert got[r.doc_id].n_tokens == n and np.allclose([got[r.doc_id][f"p_{d}"] for d in mixing.DOMAINS], p, atol=1e-9)


def test_recall_on_a_whole_table(spark):
    table = common.read_table(spark, SF.replace("0.001", "0.01"), "embeddings")
    rows = table.select("vec_id", "embedding").collect()
    got = {}
    for r in ann.search(table, F.col("row") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r
    x = ann.unit(np.array([r.embedding for r in rows], float))
    ids = np.array([r.vec_id for r in rows])
    hit = seen = 0
    for q in got:
        score = x @ x[ids == q][0]
        best = [i for i in ids[np.lexsort((ids, -score))] if i != q][:5]
        hit += len(set(best) & {r.vec_id for r in got[q].values()})
        seen += got[q][1].n_candidates
        assert [r.score for _, r in sorted(got[q].items())] == sorted((r.score for r in got[q].values()), reverse=True)
    assert len(got) == 10 and hit >= 0.9 * 5 * len(got)
    assert seen < 0.15 * len(got) * len(ids)  # 500 rows only; 5 % of all pairs on a table of 10,256
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 256, (300, ann.BITS // 8), np.uint8)
    codes[200:] = codes[:100] ^ np.packbits(rng.random((100, ann.BITS)) < 0.1, axis=1)
    shard = ann.Shard(codes)
    apart = np.bitwise_count(codes[:, None, :] ^ codes[None, :, :]).sum(axis=2)
    for radius in (0, 7, 25, 33, 130, ann.BITS):
        assert all(shard.within(codes[i], radius).tolist() == np.flatnonzero(apart[i] <= radius).tolist() for i in range(0, 300, 7))


def test_mixing_meets_targets(spark, docs, no_docs):
    import random

    rng = random.Random(0)
    kinds = {"clean": ["sun", "sea", "sand", "sky"], "toxic": ["scum", "sun", "sea", "trash"], "low": ["!!", "$$$", "sun", "!!"]}
    rows, labels = [], []
    for i in range(900):
        kind = ("clean", "clean", "clean", "clean", "toxic", "low")[i % 6]
        rows.append((i, " ".join(rng.choice(kinds[kind]) for _ in range(rng.randrange(10, 60))), kind))
        if i // 6 % 2:
            labels.append((i, int(kind != "low"), int(kind == "toxic")))
    df = spark.createDataFrame(rows, "doc_id long, text string, kind string")
    marks = spark.createDataFrame(labels + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    targets = {"clean": 0.9, "low": 0.08, "toxic": 0.02}
    got = mixing.mix(df, marks, targets)
    sums = got.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in mixing.DOMAINS]).first().asDict()
    total = sum(sums.values())
    assert all(abs(sums[d] / total - targets[d]) < 1e-4 for d in targets) and got.first().residual < 1e-4
    assert got.filter("rate < 0 OR copies < floor(rate) OR copies > ceil(rate)").count() == 0
    boxed = mixing.mix(df, marks, targets, most=1.0)
    rows = boxed.collect()
    p = np.array([[r[f"p_{d}"] * r.n_tokens for d in mixing.DOMAINS] for r in rows])
    rate = np.array([r.rate for r in rows])
    assert rate.min() >= 0 and rate.max() <= 1
    goal = np.minimum(p.sum(0), [targets[d] * p[:, 0].sum() / targets["clean"] for d in mixing.DOMAINS])
    assert np.abs(rate @ p - brute_mix(p, goal) @ p).max() < 0.01 * goal.sum() and np.abs(rate @ p - goal).max() < 0.01 * goal.sum()
    kept = mixing.keep_mixed(df, marks, targets)
    by = {r.kind: r.n for r in kept.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kept.columns == df.columns and by["clean"] >= 590 and by.get("toxic", 0) < 40
    # taking whole documents moves totals by chance only: within four standard deviations of what the rates say
    tokens = {r.doc_id: r for r in rows}
    got_p = sum(np.array([tokens[r.doc_id][f"p_{d}"] * tokens[r.doc_id].n_tokens for d in mixing.DOMAINS]) for r in kept.select("doc_id").collect())
    assert (np.abs(got_p - rate @ p) <= 4 * np.sqrt((p**2 * (rate * (1 - rate))[:, None]).sum(0)) + 1).all()
    clash = df.withColumns({"rate": F.lit("x"), "row": F.lit("x"), "copies": F.lit("x")})
    assert sorted(r.doc_id for r in mixing.keep_mixed(clash, marks, targets).collect()) == sorted(r.doc_id for r in kept.collect())
    assert mixing.mix(docs, marks.limit(0)).count() == docs.count()  # no labels: priors alone
    assert mixing.mix(no_docs, marks).count() == 0 and mixing.keep_mixed(docs, marks).columns == docs.columns
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_row_numbers_and_components(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v")).repartition(5)
    rows, n = common.numbered(df, ["k", "v"])
    assert n == 1000 and [r.row_no for r in rows.orderBy("k", "v").collect()] == list(range(1000))
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).filter("a <> 150")
    got = {r.node: r.root for r in common.connected_components(chain).collect()}
    assert got == {i: 0 if i <= 150 else 151 for i in range(301)}
    assert common.connected_components(chain.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_pipeline_against_its_steps(spark):
    """run() against the same decisions made one document at a time."""
    import corpus_pipeline
    from terrasieve.llm import bpe, lines, quality

    from .test_text_operators import shingles_of, told_by

    docs, labels = (common.read_table(spark, SF, t) for t in ("documents", "labels"))
    model = quality.fit(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    good = [(r.doc_id, r.text) for r, s in zip(rows, model.calibrated(model.measures([r.text for r in rows]))) if s >= quality.THRESHOLD]
    told = told_by(good)
    cut = [(doc, lines.remove(text, told, doc)[0]) for doc, text in good]
    sets = {doc: shingles_of(text) for doc, text in cut}
    root = {doc: doc for doc in sets}
    for a, b in itertools.combinations(sorted(sets), 2):  # all pairs, and not those that short SimHashes propose
        if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            low, high = sorted((root[a], root[b]))
            root = {d: low if r == high else r for d, r in root.items()}
    kept = [(d, t) for d, t in cut if root[d] == d]
    mixed = mixing.keep_mixed(spark.createDataFrame(kept, "doc_id long, text string"), labels)
    codec = bpe.Codec(open(bpe.default_vocabulary()[0], "rb").read(), bpe.default_vocabulary()[1])
    want = {r.doc_id: codec.encode(r.text).tolist() for r in mixed.collect()}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id: r.ids for r in got} == want and all(r.exact and r.n_tokens == len(r.ids) for r in got)
    assert len(corpus_pipeline.STAGES) == 5 and len(got) < len(rows)
