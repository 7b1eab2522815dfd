import numpy as np

from driftline.llm import mixture as M

DOCS = "doc_id bigint, source string, text string, block int, place string"


def docs(spark, sizes):
    rows, k = [], 0
    for source, n in sizes.items():
        for i in range(n):
            k += 1
            rows.append((k, [source, source.upper().replace("_", " "), f" {source.replace('_', '-')} "][i % 3], " ".join(["token"] * (1 + i % 9)), 1, "x"))
    rows += [(k + 1, None, "no source", 1, "x"), (k + 2, "elsewhere", "no target", 1, "x"), (k + 3, "big_one", None, 1, "x"), (k + 4, "big_one", "", 1, "x")]
    return spark.createDataFrame(rows, DOCS)


def test_splitting_is_exact_and_even():
    rng = np.random.default_rng(1)
    draws = np.array([1000, 37, 0, 5], np.int64)
    out = M.split_draws(draws, 7, rng)
    assert out.shape == (7, 4) and (out.sum(axis=0) == draws).all() and out.min() >= 0
    assert out.sum(axis=1).max() - out.sum(axis=1).min() <= 3
    share = np.mean([M.split_draws(draws, 4, np.random.default_rng(s))[0, 0] for s in range(200)])
    assert abs(share - 250) < 2


def test_targets_caps_and_disjoint_use(spark):
    sizes = {"big_one": 3000, "small": 100, "tiny": 5}
    df = docs(spark, sizes)
    targets = spark.createDataFrame([("big_one", 0.5, 1), ("Small", 0.3, 4), ("tiny", 0.1, 2), ("absent", 0.1, 3), (None, 0.2, 1), ("never", 0.0, 1), ("bad", None, None)], "source string, target_share double, max_repeats int")
    one = M.mix(df, targets, shards=4, budget=5000).collect()
    tokens = {s: sum(r.n_tokens for r in one if r.source == s) for s in ("big_one", "small", "tiny")}
    have = {s: sum(r.n_tokens for r in M.token_counts(df).collect() if r.source == s) for s in tokens}
    assert 2500 - 9 < tokens["big_one"] <= 2500 and 1500 - 9 < tokens["small"] <= 1500
    assert tokens["tiny"] == 2 * have["tiny"] and {r.source for r in one} == set(tokens)
    used = {}
    for r in one:
        used.setdefault((r.source, r.doc_id), []).append(r.pass_no)
    cap = {"big_one": 1, "small": 4, "tiny": 2}
    assert all(len(p) == len(set(p)) <= cap[s] for (s, _), p in used.items())
    again = M.mix(df, targets, shards=4, budget=5000).collect()
    assert sorted(map(str, again)) == sorted(map(str, one))
    shares = {r.source: r for r in M.shares(M.mix(df, targets, shards=4, budget=5000), targets.filter("source IS NOT NULL")).collect()}
    assert abs(shares["big_one"].actual_share - tokens["big_one"] / sum(tokens.values())) < 1e-9 and shares["absent"].tokens == 0


def test_every_shard_has_partitions_of_its_own(spark, monkeypatch):
    df = docs(spark, {"a": 800, "b": 300})
    targets = spark.createDataFrame([("a", 0.6, 1), ("b", 0.4, 3)], "source string, target_share double, max_repeats int")
    one = sorted(map(tuple, M.mix(df, targets, shards=5).collect()))
    for records, cells in ((10_000, 5), (60, 20)):
        got = M.mix(df, targets, shards=5, part_records=records)
        parts = [p for p in got.rdd.glom().collect() if p]
        assert all(len({r.shard for r in p}) == 1 for p in parts) and len(parts) >= cells
        rows = [r for p in parts for r in p]
        assert [(r.shard, r.shuffle_key) for r in rows] == sorted((r.shard, r.shuffle_key) for r in rows)
        assert sorted(map(tuple, rows)) == one
    # a plan too long to send around is joined, and gives the same
    monkeypatch.setattr(M.scan, "SMALL_ROWS", 0)
    assert sorted(map(tuple, M.mix(df, targets, shards=5).collect())) == one


def test_shards_follow_the_tokens(spark, monkeypatch):
    df = docs(spark, {"a": 500})
    targets = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    monkeypatch.setattr(M, "SHARD_TOKENS", 50)
    got = M.mix(df, targets)
    assert got.rdd.getNumPartitions() == -(-sum(r.n_tokens for r in M.token_counts(df.filter("lower(source) in ('a', ' a ')")).collect()) // 50) > M.MIN_SHARDS


def test_nothing_to_mix(spark):
    df = docs(spark, {"a": 3})
    t = "source string, target_share double, max_repeats int"
    assert M.mix(df, spark.createDataFrame([], t)).count() == 0
    assert M.mix(df.limit(0), spark.createDataFrame([("a", 1.0, 1)], t)).count() == 0
