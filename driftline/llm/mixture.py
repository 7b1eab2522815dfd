"""Mixing sources to target weights.

Sizes are tokens of a public tokenizer.  A source's quota is its target share of the budget, at most
``max_repeats`` times what it has.  Records are hashed into permuted blocks a source (BLOCKS or more); a quota is
that many whole passes over all blocks and one pass over a prefix of the permuted blocks, whose last
block is cut record by record.  A splitting tree divides the exact numbers of block draws of all sources
among the output shards: each node draws its left half's numbers from the multivariate hypergeometric
distribution.  Each source's draws are then permuted and dealt to the shards as disjoint runs, and
within a shard the records are shuffled by a hash.  Every shard has partitions of its own, as many as its
size asks for, in order of the shuffle key.

The number of shards, and with it of blocks, follows the tokens.  The driver holds numbers of blocks only
(sources x blocks x repeats), never records; its plan is sent to every task where it was counted to be
short, else joined.

Edge cases: records without a source, or of a source without a target, are not selected; null or empty
texts have no tokens and are selected with their block; a share of zero or a source without tokens
selects nothing; a target source without records is reported with a share of zero.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftline.core import scan
from driftline.core.store import cut

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the byte-level tokenizer cuts a text into pieces before merging.
PIECES = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Least number of blocks of a source (four a shard if that is more), and sub-blocks of a block that is cut.
BLOCKS, SUB_BLOCKS = 256, 1024
#: Tokens of a shard, where that gives more than MIN_SHARDS; records of a partition of a shard.
SHARD_TOKENS, MIN_SHARDS, PART_RECORDS = 1_000_000_000, 16, 1_000_000

_encoders: dict[str, object] = {}


def _encoder(name: str, vocabulary: bytes):
    if name not in _encoders:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line.strip())}
        _encoders[name] = tiktoken.Encoding("public", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
    return _encoders[name]


def source_name(c: Column) -> Column:
    """One spelling of a source: small letters, words joined by underscores; blank is null."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"[-_\s]+", "_")
    return F.when(bare != "", bare)


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source (one spelling), n_tokens of every document.  Only the driver needs the tokenizer's file; executors are sent it (about 1 MB)."""
    with open(tokenizer, "rb") as f:
        vocabulary = documents.sparkSession.sparkContext.broadcast(f.read())

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer, vocabulary.value).encode_ordinary
        for batch in batches:
            n = [len(encode(t)) if t else 0 for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    rows = documents.select(F.col("doc_id").cast("bigint"), source_name(F.col("source")).alias("source"), F.col("text").cast("string"))
    return rows.mapInArrow(task, "doc_id bigint, source string, n_tokens bigint")


def split_draws(draws: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """Numbers of draws per (shard, source): rows sum to equal sizes (up to one), columns to ``draws`` exactly."""
    if shards == 1:
        return draws[None, :]
    left = shards // 2
    size = int(draws.sum()) * left // shards
    mine = rng.multivariate_hypergeometric(draws, size, method="marginals") if draws.sum() else draws * 0
    return np.vstack([split_draws(mine, left, rng), split_draws(draws - mine, shards - left, rng)])


def _targets(mix_targets: DataFrame) -> DataFrame:
    """source, share, cap: target share and repeats per source; spellings of one source add up, the smaller cap holds."""
    return (
        mix_targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
        .filter("source IS NOT NULL AND target_share > 0 AND max_repeats > 0")
        .groupBy("source")
        .agg(F.sum("target_share").alias("share"), F.min("max_repeats").alias("cap"))
    )


def mix(
    documents: DataFrame, mix_targets: DataFrame, shards: int | None = None, budget: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER, part_records: int = PART_RECORDS
) -> DataFrame:
    """The mixture: doc_id, source, n_tokens, pass_no, shard, shuffle_key, sorted by shuffle_key within its shard.

    ``budget`` is the wanted size in tokens, by default that of all documents of target sources; ``shards`` by
    default one for SHARD_TOKENS tokens, at least MIN_SHARDS.  No partition holds rows of two shards.
    """
    spark = documents.sparkSession
    wanted = cut(_targets(mix_targets), "mix-targets")
    targets = {r.source: (r.share, r.cap) for r in wanted.toLocalIterator()}
    empty = spark.createDataFrame([], "doc_id bigint, source string, n_tokens bigint, pass_no int, shard int, shuffle_key bigint")
    if not targets:
        return empty
    names = sorted(targets)
    hashed = F.xxhash64(F.col("doc_id"), F.lit(seed))
    mine = documents.withColumn("source", source_name(F.col("source"))).join(scan.small(wanted.select("source")), "source", "left_semi")
    counted = cut(token_counts(mine, tokenizer).withColumn("place", hashed), "token-counts")
    have_all = counted.agg(F.sum("n_tokens")).first()[0] or 0
    total = budget if budget is not None else have_all
    shards = shards or max(MIN_SHARDS, -(-total // SHARD_TOKENS))
    blocks = max(BLOCKS, 4 * shards)
    block = F.pmod(F.col("place"), F.lit(blocks)).cast("int")
    sub = F.pmod(F.shiftrightunsigned("place", 20), F.lit(SUB_BLOCKS)).cast("int")
    rows = counted.withColumns({"block": block, "sub": sub})
    size = {(r.source, r.block): (r.t, r.n) for r in rows.groupBy("source", "block").agg(F.sum("n_tokens").alias("t"), F.count("*").alias("n")).collect()}
    tokens = {s: np.array([size.get((s, b), (0, 0))[0] for b in range(blocks)], np.int64) for s in names}
    records = sum(n for _, n in size.values())
    rng = np.random.default_rng(seed)
    draws: dict[str, np.ndarray] = {}  # rows (block, pass)
    cuts: dict[str, tuple[int, int, int]] = {}  # source -> block, pass, tokens left for the block that is cut
    most = 1
    for s in names:
        share, cap = targets[s]
        have = int(tokens[s].sum())
        quota = int(min(share * total, cap * have)) if have else 0
        whole, rest = divmod(quota, have) if have else (0, 0)
        most = max(most, whole + 1)
        order = rng.permutation(blocks)
        full = np.column_stack([np.tile(order, whole), np.repeat(np.arange(whole), blocks)])
        # of the last pass the blocks that fit as a whole, and the one that is cut
        filled = np.cumsum(tokens[s][order])
        n = int(np.searchsorted(filled, rest, side="right"))
        left = rest - (int(filled[n - 1]) if n else 0)
        if n < blocks and left:
            cuts[s] = (int(order[n]), whole, left)
            n += 1
        draws[s] = np.vstack([full, np.column_stack([order[:n], np.full(n, whole)])])
    numbers = split_draws(np.array([len(draws[s]) for s in names], np.int64), shards, rng)
    dealt = []
    for k, s in enumerate(names):
        own = draws[s][rng.permutation(len(draws[s]))]
        dealt.append(pd.DataFrame({"source": s, "block": own[:, 0], "pass_no": own[:, 1], "shard": np.repeat(np.arange(shards), numbers[:, k])}))
    dealt = pd.concat(dealt)
    if not len(dealt):
        return empty
    plan = spark.createDataFrame(dealt.astype({c: "int32" for c in ("block", "pass_no", "shard")}), "source string, block int, pass_no int, shard int")
    chosen = rows.join(F.broadcast(plan) if len(dealt) <= scan.SMALL_ROWS else cut(plan, "mix-plan"), ["source", "block"])
    if cuts:
        chosen = _cut_blocks(rows, chosen, cuts)
    key = F.xxhash64("place", "pass_no", F.lit(seed + 1))
    out = chosen.select("doc_id", "source", "n_tokens", "pass_no", "shard", key.alias("shuffle_key"))
    # a shard is cut where the leading bits of the key change; most is how often a record may be used
    bits = max(0, min(16, math.ceil(math.log2(max(1, records * most / shards / part_records)))))
    part = F.shiftrightunsigned(F.col("shuffle_key").bitwiseXOR(F.lit(-(2**63)).cast("bigint")), 64 - bits).cast("int") if bits else F.lit(0)
    return out.repartitionById(shards << bits, F.col("shard") * F.lit(1 << bits) + part).sortWithinPartitions("shard", "shuffle_key")


def _cut_blocks(rows: DataFrame, chosen: DataFrame, cuts: dict[str, tuple[int, int, int]]) -> DataFrame:
    """Of each cut block keep records in hash order while they fit: whole sub-blocks first, then single records of one sub-block."""
    spark = rows.sparkSession
    few = len(cuts) <= scan.SMALL_ROWS  # one row a source
    small = lambda df: F.broadcast(df) if few else df
    edge = spark.createDataFrame([(s, b, p, left) for s, (b, p, left) in cuts.items()], "source string, block int, cut_pass int, room bigint")
    inside = rows.join(small(edge), ["source", "block"])
    subs: dict[str, list[tuple[int, int]]] = {}
    for r in inside.groupBy("source", "sub").agg(F.sum("n_tokens").alias("t")).orderBy("source", "sub").collect():
        subs.setdefault(r.source, []).append((r.sub, r.t))
    last = []
    for s, (_, _, room) in cuts.items():
        at = SUB_BLOCKS
        for number, t in subs.get(s, []):
            if t > room:
                at = number
                break
            room -= t
        last.append((s, at, room))
    limit = spark.createDataFrame(last, "source string, last_sub int, sub_room bigint")
    in_order = Window.partitionBy("source").orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    fitting = (
        inside.join(small(limit), "source")
        .filter("sub = last_sub")
        .select("source", "doc_id", "place", "sub_room", F.sum("n_tokens").over(in_order).alias("used"))
        .filter("used <= sub_room")
        .groupBy("source")
        .agg(F.max(F.struct("place", "doc_id")).alias("upto"))
    )
    marked = chosen.join(small(edge.select("source", "block", F.col("cut_pass").alias("pass_no"), F.lit(True).alias("is_cut"))), ["source", "block", "pass_no"], "left")
    marked = marked.join(small(limit), "source", "left").join(small(fitting), "source", "left")
    keep = F.col("is_cut").isNull() | (F.col("sub") < F.col("last_sub")) | ((F.col("sub") == F.col("last_sub")) & (F.struct("place", "doc_id") <= F.col("upto")))
    return marked.filter(keep)


def shares(selection: DataFrame, mix_targets: DataFrame) -> DataFrame:
    """source, target_share, actual_share, tokens, records, most_repeats reached by a selection."""
    wanted = mix_targets.groupBy(source_name(F.col("source")).alias("source")).agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    got = cut(selection.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("records"), (F.max("pass_no") + 1).alias("most_repeats")), "mix-shares")
    both = wanted.join(scan.small(got), "source", "left").na.fill(0, ["tokens", "records", "most_repeats"])
    total = F.sum("tokens").over(Window.partitionBy(F.lit(0)))
    return both.select("source", "target_share", "max_repeats", "tokens", "records", "most_repeats", (F.col("tokens") / F.nullif(total, F.lit(0))).alias("actual_share"))
