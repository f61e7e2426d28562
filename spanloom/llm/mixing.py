"""Sources mixed to target shares of all tokens (problem 7).

Documents of a source lie in blocks by hash; a permutation of the blocks, another one for each
repeat, gives the order in which they are drawn. The quota of a source is whole passes over its
blocks and a prefix of one more. A splitting tree halves the output shards again and again and
draws, at each node, how many of each source's blocks go left from the multivariate
hypergeometric distribution; so each shard gets an exact number of disjoint blocks of each
source. The driver draws the tree down to groups of shards, the task that is given a group the
rest. Within a shard documents are ordered by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spanloom.functions.arrow_groups import boundaries, whole_groups
from spanloom.llm.tokenizer import token_counts
from spanloom.session import materialize

#: Documents of a block, tokens of an output shard, shards of a group, and stretches of blocks whose sizes reach the driver at a time.
BLOCK_DOCS = 64
SHARD_TOKENS = 2_000_000
GROUP_SHARDS = 64
STRETCHES = 1024

MIXED = "doc_id long, source string, repeat int, shard int, place int, tokens long"


def _permutation(blocks: int, rng: np.random.Generator) -> tuple[int, int]:
    """Factor and offset of a permutation i -> (factor * i + offset) mod blocks."""
    factor = int(rng.integers(1, blocks + 1))
    while math.gcd(factor, blocks) != 1:
        factor = factor % blocks + 1
    return factor, int(rng.integers(0, blocks))


def splitting_tree(counts: np.ndarray, shards: int, rng: np.random.Generator, leaf: int = 1) -> np.ndarray:
    """Blocks of each source (columns) for each leaf of up to so many shards (rows), in order; columns sum to counts.

    Only the last leaf may have fewer shards than leaf; draws are in proportion to the shards.
    """
    leaves = -(-shards // leaf)
    out = np.zeros((leaves, len(counts)), np.int64)
    open_ = [(0, leaves, counts.astype(np.int64))]
    while open_:
        first, n, have = open_.pop()
        if n == 1:
            out[first] = have
            continue
        left = n // 2
        width = min((first + n) * leaf, shards) - first * leaf
        taken = np.zeros_like(have)
        rest, want = int(have.sum()), int(round(have.sum() * (left * leaf) / width))
        for i, k in enumerate(have.tolist()):  # a multivariate draw, one source after another
            rest -= k
            taken[i] = _hypergeometric(rng, k, rest, want)
            want -= int(taken[i])
        open_ += [(first, left, taken), (first + left, n - left, have - taken)]
    return out


def _log_factorial_step(x: int, d: int) -> float:
    """log((x + d)! / x!), exact to rounding also where the factorials are vast."""
    if min(x, x + d) < 1000:
        return math.lgamma(x + d + 1) - math.lgamma(x + 1)
    return (x + 0.5) * math.log1p(d / x) + d * math.log(x + d) - d + 1 / (12 * (x + d)) - 1 / (12 * x)


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """Good ones among draws out of good and bad, drawn exactly at any size."""
    if not good or not draws:
        return 0
    if not bad:
        return min(good, draws)
    if good + bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    return rejected_hypergeometric(rng, good, bad, draws)


def rejected_hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """The same by rejection, for what the library's sampler refuses.

    The weights are log-concave, so those k steps from the mode, whose weight is p, lie below
    p * min(1, exp(1 - p * k)); proposals come from that hull.
    """
    n = good + bad
    low, high = max(0, draws - bad), min(good, draws)
    mode = min(max((draws + 1) * (good + 1) // (n + 2), low), high)

    def log_ratio(d: int) -> float:
        return -sum(_log_factorial_step(x, s * d) for x, s in ((mode, 1), (good - mode, -1), (draws - mode, -1), (bad - draws + mode, 1)))

    deviation = math.sqrt(draws * (good / n) * (bad / n) * ((n - draws) / (n - 1)))
    p = 0.9 / (math.sqrt(2 * math.pi) * deviation + 1)  # at most the mode's weight, so that the hull stays above
    width = 1 + p / 2
    while True:
        if rng.random() <= width / (1 + width):
            y = rng.random() * width / p
        else:
            y = (width + rng.exponential()) / p
        d = int(round(y)) * (1 if rng.random() < 0.5 else -1)
        if low <= mode + d <= high and math.log(1 - rng.random()) + min(0.0, width - p * y) <= log_ratio(d):
            return mode + d


def feasible_total(tokens: dict[str, int], targets: dict[str, tuple[float, int]]) -> tuple[float, dict[str, float]]:
    """The most tokens that keep every share within its source's repeats, and the shares used.

    Sources without tokens can't take part; the shares of the others are scaled to sum to 1.
    """
    there = {s: share for s, (share, cap) in targets.items() if tokens.get(s, 0) > 0 and share > 0 and cap > 0}
    scale = sum(there.values())
    shares = {s: share / scale for s, share in there.items()}
    return min((targets[s][1] * tokens[s] / share for s, share in shares.items()), default=0.0), shares


def _cuts(ordered: DataFrame, room: dict[str, float], blocks: dict[str, int]) -> dict[str, tuple[int, float]]:
    """Of each source the rank of the block in which its quota of the last pass ends, and the tokens left for that block.

    Sums of STRETCHES stretches of ranks a source reach the driver, then those of the stretch
    that holds the end, until it is one block. A source whose quota lies beyond its last block
    has no entry.
    """
    spark = ordered.sparkSession
    spans = {s: (0, blocks[s], tokens) for s, tokens in room.items()}  # ranks [from, to) and the tokens left at from
    found: dict[str, tuple[int, float]] = {}
    while spans:
        frame = spark.createDataFrame([(s, a, -(-(b - a) // STRETCHES), b) for s, (a, b, _) in spans.items()], "source string, from long, step long, to long")
        within = ordered.join(F.broadcast(frame), "source").where("rank >= `from` and rank < `to`")
        sums = within.groupBy("source", "step", F.expr("(rank - `from`) div step").alias("k")).agg(F.sum("tokens").alias("t")).collect()
        by: dict[str, list[tuple[int, int, int]]] = {}
        for r in sums:
            by.setdefault(r["source"], []).append((r["k"], r["t"], r["step"]))
        narrowed = {}
        for s, (a, b, left) in spans.items():
            for k, t, step in sorted(by.get(s, [])):
                if t > left:
                    narrowed[s] = (a + k * step, min(a + (k + 1) * step, b), left)
                    break
                left -= t
        found |= {s: (a, left) for s, (a, b, left) in narrowed.items() if b - a == 1}
        spans = {s: x for s, x in narrowed.items() if x[1] - x[0] > 1}
    return found


def _to_group(names: list[str], bounds):
    """Adds the group of shards that each unit belongs to; bounds is a broadcast (sources, groups + 1) array."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source = np.searchsorted(names, batch["source"].to_numpy(zero_copy_only=False).astype(str))
            unit = batch["unit"].to_numpy()
            group = np.zeros(len(unit), np.int64)
            for i in np.unique(source):
                at = source == i
                group[at] = np.searchsorted(bounds.value[i], unit[at], "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(group)], names=[*batch.schema.names, "group"])

    return work


def _to_shard(names: list[str], bounds, shards: int, seed: int):
    """Shard and place of the rows of whole groups, by the group's part of the tree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["group"]):
            starts = boundaries(table, ["group"])
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), table.num_rows], strict=True):
                part = table.slice(a, b - a).combine_chunks()
                g = part["group"][0].as_py()
                first = g * GROUP_SHARDS
                counts = bounds.value[:, g + 1] - bounds.value[:, g]
                tree = splitting_tree(counts, min(GROUP_SHARDS, shards - first), np.random.default_rng([seed, g]))
                upto = np.cumsum(tree, 0)
                source = np.searchsorted(names, part["source"].to_numpy().astype(str))
                unit = part["unit"].to_numpy() - bounds.value[source, g]
                shard = np.zeros(len(unit), np.int64)
                for i in np.unique(source):
                    at = source == i
                    shard[at] = np.searchsorted(upto[:, i], unit[at], "right")
                order = np.lexsort((part["repeat"].to_numpy(), part["doc_id"].to_numpy(), part["mixed"].to_numpy(), shard))
                shard = shard[order]
                begin = np.concatenate(([0], np.flatnonzero(np.diff(shard)) + 1)).astype(np.int64)
                place = np.arange(len(shard)) - np.repeat(begin, np.diff(np.concatenate((begin, [len(shard)])))) + 1
                part = part.take(pa.array(order))
                columns = [part["doc_id"], part["source"], part["repeat"], pa.array(shard + first, pa.int32()), pa.array(place, pa.int32()), part["tokens"]]
                yield from pa.table(columns, names=[x.split()[0] for x in MIXED.split(", ")]).combine_chunks().to_batches()

    return work


def mix(documents: DataFrame, targets: DataFrame, total: float | None = None, seed: int = 11, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, source, repeat, shard, place, tokens) of the mixture.

    total is the size in tokens; unset, the largest in which no document of a source is used
    more than its max_repeats times; more than that raises ValueError. Documents of other or
    null sources, and documents without tokens (null or empty text), take no part. Shares are
    met up to one document a source. Rows with the same doc_id count as different documents if
    they are. Targets with a null source, share or cap don't count. place orders a shard by hash.

    The bounds of the groups of shards are broadcast: 8 bytes a source and GROUP_SHARDS shards.
    """
    spark = documents.sparkSession
    goal = {r["source"]: (float(r["target_share"]), int(r["max_repeats"])) for r in targets.where("source is not null and target_share is not null and max_repeats is not null").collect()}
    counted = token_counts(documents.join(F.broadcast(targets.select("source").distinct()), "source", "left_semi"), ["doc_id", "source"])
    counted = materialize(counted.where("tokens > 0"), "token-counts")
    sizes = {r["source"]: (r["n"], r["t"]) for r in counted.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).collect()}
    most, shares = feasible_total({s: t for s, (_, t) in sizes.items()}, goal)
    if total is not None and total > most * (1 + 1e-9):
        raise ValueError(f"no more than {most:.0f} tokens keep these shares within the repeats")
    whole = most if total is None else total
    if not shares:
        return spark.createDataFrame([], MIXED)

    rng = np.random.default_rng(seed)
    plan = []  # of each source: blocks, passes, tokens of the last pass, its permutations
    for s in sorted(shares):
        n, t = sizes[s]
        blocks = max(1, -(-n // BLOCK_DOCS))
        quota = shares[s] * whole
        passes = min(int(quota / t + 1e-9), goal[s][1])
        plan.append((s, blocks, passes, max(0.0, quota - passes * t), [_permutation(blocks, rng) for _ in range(passes + 1)]))

    shape = spark.createDataFrame([(s, b) for s, b, *_ in plan], "source string, blocks long")
    hashed = F.xxhash64(F.lit(seed), "doc_id", "tokens")
    docs = counted.join(F.broadcast(shape), "source").withColumn("hash", hashed).withColumn("block", F.pmod("hash", "blocks"))
    rank = ((F.col("factor") * F.col("block") + F.col("offset")) % F.col("blocks")).alias("rank")

    # the last pass: blocks in the order of its permutation until the quota is full
    room = {s: rest for s, _, _, rest, _ in plan if rest > 0}
    last = spark.createDataFrame([(s, p[-1][0], p[-1][1]) for s, *_, p in plan if s in room], "source string, factor long, offset long")
    ordered = docs.join(F.broadcast(last), "source").select("doc_id", "source", "tokens", "hash", rank)
    cuts = _cuts(ordered, room, {s: b for s, b, *_ in plan})
    cut = spark.createDataFrame([(s, k, float(left)) for s, (k, left) in cuts.items()], "source string, cut long, left double")
    with_cut = ordered.join(F.broadcast(cut), "source", "left")
    running = Window.partitionBy("source").orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    edge = with_cut.where("rank = cut").withColumn("upto", F.sum("tokens").over(running)).where("upto - tokens / 2 <= left")  # one block a source
    columns = ["doc_id", "source", "tokens", "hash", "rank"]
    drawn = [x.select(*columns, F.lit(-1).alias("repeat")) for x in (with_cut.where("cut is null or rank < cut"), edge)]
    passes = [(s, i, f, o) for s, _, n, _, p in plan for i, (f, o) in enumerate(p[:n])]
    if passes:
        full = spark.createDataFrame(passes, "source string, repeat int, factor long, offset long")
        drawn.append(docs.join(F.broadcast(full), "source").select("doc_id", "source", "tokens", "hash", rank, "repeat"))
    drawn = materialize(reduce(DataFrame.unionByName, drawn), "drawn")

    # units are the blocks of a source's passes, numbered one pass after another
    used = {r["source"]: r["k"] for r in drawn.where("repeat = -1").groupBy("source").agg((F.max("rank") + 1).alias("k")).collect()}
    names = sorted(shares)
    units = np.array([n * b + used.get(s, 0) for s, b, n, *_ in plan], np.int64)
    shards = max(1, math.ceil(whole / shard_tokens))
    tree = splitting_tree(units, shards, rng, GROUP_SHARDS)
    bounds = spark.sparkContext.broadcast(np.concatenate((np.zeros((1, len(names)), np.int64), np.cumsum(tree, 0))).T.copy())
    told = spark.createDataFrame([(s, n, b) for s, b, n, *_ in plan], "source string, passes int, blocks long")
    repeat = F.when(F.col("repeat") < 0, F.col("passes")).otherwise(F.col("repeat")).cast("int")
    placed = drawn.join(F.broadcast(told), "source").select("doc_id", "source", "tokens", repeat.alias("repeat"), (repeat * F.col("blocks") + F.col("rank")).alias("unit"), F.xxhash64(F.lit(seed), "hash", repeat).alias("mixed"))
    grouped = placed.mapInArrow(_to_group(names, bounds), "doc_id long, source string, tokens long, repeat int, unit long, mixed long, group long")
    return grouped.repartition("group").sortWithinPartitions("group").mapInArrow(_to_shard(names, bounds, shards, seed), MIXED)


def reached(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """Of each source its target and actual share, documents, tokens and greatest use of a document."""
    uses = mixed.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("uses"), F.sum("tokens").alias("tokens"))
    got = uses.groupBy("source").agg(F.sum("uses").alias("documents"), F.sum("tokens").alias("tokens"), F.max("uses").alias("most_uses"))
    joined = targets.join(got, "source", "left")
    total = F.sum("tokens").over(Window.partitionBy(F.lit(1)))  # of one row a source
    return joined.withColumn("actual_share", F.coalesce(F.col("tokens") / total, F.lit(0.0))).select("source", "target_share", "max_repeats", "actual_share", F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"))
