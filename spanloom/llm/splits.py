"""Splits that keep the records of one person together (problem 2).

Persons are connected components over patient numbers and aliases. Components of the same size
and label profile form a bundle. A flow from bundles to splits, with convex costs of leaving the
quotas of sizes and labels, gives whole numbers of components; the members of a bundle are dealt
by the order of their hash. Only counts of bundles by size and main label reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spanloom.session import materialize

#: The ways a split is spelled, the prefixes of session keys, and the proportions.
SPELLINGS = {"train": "train", "trn": "train", "training": "train", "dev": "dev", "vld": "dev", "validation": "dev", "eval": "eval", "tst": "eval", "test": "eval"}
PREFIXES = {"trn": "train", "vld": "dev", "tst": "eval"}
PROPORTIONS = {"train": 0.8, "dev": 0.1, "eval": 0.1}
#: Cost of a row off a split's size quota, in rows off a label's quota; the least gain that counts, a row off one label.
SIZE_COST, EPSILON = 1e6, 1.0
#: How often a flow is disturbed and settled again while its sizes are off their rounded quotas.
KICKS = 200
#: Members of a bundle, or of bundles of one size and main label, that are ranked in one task, about.
RANK_ROWS = 100_000


def _lookup(value: Column, table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[value]


def patient_number(text: Column) -> Column:
    """The number in a patient id without leading zeros, as text; null where there is none."""
    digits = F.regexp_extract(text, r"([0-9]+)\D*$", 1)
    return F.when(digits != "", F.regexp_replace(digits, r"^0+(?=[0-9])", ""))


def delivered_split(split: Column, session_key: Column) -> Column:
    """train, dev or eval by the spelled split, else by the key's prefix."""
    spelled = _lookup(F.lower(F.regexp_replace(split, r"^\s+|\s+$", "")), SPELLINGS)
    return F.coalesce(spelled, _lookup(F.lower(F.split_part(session_key, F.lit("_"), F.lit(1))), PREFIXES))


def connected_components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of the nodes of edges (a, b); root is the least node of the component.

    Large-star and small-star steps in turn until nothing changes; each round is written to the
    shared folder. Loops, repeated and reversed edges change nothing; edges with a null are
    left out. Minima are combined before the shuffle, so a hub is no hot group.
    """
    e = edges.where("a is not null and b is not null").select("a", "b")
    nodes = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    e = materialize(e.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = e.union(e.select("b", "a")).toDF("u", "v")
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a <> b").distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))  # a < b: b's neighbours below
        small = large.join(least, "b").select(F.col("m").alias("a"), F.explode(F.array("a", "b")).alias("b")).where("a <> b").distinct()
        e = materialize(small, "edges")
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def persons(sessions: DataFrame, aliases: DataFrame) -> DataFrame:
    """session_key, delivered split, montage_type and person of every row with a session_key.

    A person is the least of the patient numbers tied together by aliases. Where patient_id is
    missing, blank or without digits, the patient in session_key counts; a key without one is a
    person of its own. Aliases that lack a side tie nothing.
    """
    own = patient_number(F.col("patient_id"))
    rows = sessions.where("session_key is not null").select(
        "session_key",
        delivered_split(F.col("split"), F.col("session_key")).alias("split"),
        F.regexp_replace(F.lower("montage_type"), r"[^a-z]", "").alias("label"),
        F.coalesce(own, patient_number(F.split_part("session_key", F.lit("_"), F.lit(2))), F.col("session_key")).alias("number"),
    )
    tied = connected_components(aliases.select(patient_number(F.col("old_id")).alias("a"), patient_number(F.col("new_id")).alias("b")))
    return rows.join(tied, rows["number"] == tied["node"], "left").select("session_key", "split", "label", F.coalesce("root", "number").alias("person"))


def spread_sessions(sessions: DataFrame, aliases: DataFrame) -> DataFrame:
    """(session_key), distinct, of persons with sessions in more than one delivered split."""
    rows = persons(sessions, aliases)
    over = rows.groupBy("person").agg(F.count_distinct("split").alias("n")).where("n > 1")
    return rows.join(over, "person", "left_semi").select("session_key").distinct()


def _rounded_best(slope: np.ndarray, square: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole c in 0..most with the least 2 c slope + c² square, and that cost."""
    with np.errstate(divide="ignore", invalid="ignore"):
        best = np.where(square > 0, -slope / square, 0.0)
    c = np.clip(np.floor(best), 0, most)
    up = np.clip(np.ceil(best), 0, most)
    cost, cost_up = (2 * x * slope + x * x * square for x in (c, up))
    return np.where(cost_up < cost, up, c).astype(np.int64), np.minimum(cost, cost_up)


class _Flow:
    """Components of each group by split, with what each split's size and labels are off their quotas."""

    def __init__(self, groups: list[tuple[int, int]], shares: list[float], labels: np.ndarray | None):
        self.size = np.array([s for s, _ in groups], np.int64)
        self.count = np.array([n for _, n in groups], np.int64)
        self.labels = np.zeros((len(groups), 0)) if labels is None else np.asarray(labels, float)
        self.square = (self.labels**2).sum(1)
        self.quota = np.array(shares) * float((self.size * self.count).sum())
        self.wanted = np.outer(self.labels.T @ self.count, shares)
        self.sent = np.floor(np.outer(self.count, shares) + 1e-9).astype(np.int64)
        self.left = self.count - self.sent.sum(1)
        self.measure()
        self.least = self._least()

    def measure(self) -> None:
        self.off = (self.size @ self.sent).astype(float) - self.quota
        self.off_labels = self.labels.T @ self.sent - self.wanted

    def _least(self) -> float:
        """What the size cost can't fall below: quotas rounded to the sizes' common divisor, wherever the largest component lies."""
        unit, largest = int(np.gcd.reduce(self.size)), int(self.size.max())
        total, n = float(self.quota.sum()), len(self.quota)

        def rounded(quota: np.ndarray, rest: float) -> np.ndarray:  # largest remainders first
            whole = np.floor(quota / unit + 1e-9)
            whole[np.argsort(-(quota / unit - whole), kind="stable")[: round(rest / unit - whole.sum())]] += 1
            return whole * unit

        costs = []
        for j in range(n):
            reached, over = np.zeros(n), largest - self.quota[j]
            if over <= 0 or n == 1:
                reached = rounded(self.quota, total)
            else:
                others = np.arange(n) != j
                reached[j] = largest
                reached[others] = rounded(self.quota[others] - over / (n - 1), total - largest)
            costs.append(float(((reached - self.quota) ** 2).sum()))
        return min(costs)

    def size_cost(self) -> float:
        return float((self.off**2).sum())

    def cost(self) -> float:
        return SIZE_COST * self.size_cost() + float((self.off_labels**2).sum())

    def put(self, i: int, j: int, n: int) -> None:
        self.sent[i, j] += n
        self.off[j] += n * int(self.size[i])
        self.off_labels[:, j] += n * self.labels[i]

    def move(self, i: int, j: int, to: int, n: int) -> None:
        self.put(i, j, -n)
        self.put(i, to, n)

    def fill(self) -> None:
        """Components that the floors leave over, the largest first, each where it costs least."""
        for i in np.argsort(-self.size, kind="stable").tolist():
            for _ in range(int(self.left[i])):
                cost = SIZE_COST * (2 * self.off + self.size[i]) * self.size[i] + 2 * self.labels[i] @ self.off_labels + self.square[i]
                self.put(i, int(np.argmin(cost)), 1)

    def slopes(self, j: int, to: int) -> tuple[float, np.ndarray]:
        return float(self.off[to] - self.off[j]), self.labels @ (self.off_labels[:, to] - self.off_labels[:, j])

    def _take(self, j: int, to: int, best: list[tuple[float, int, int, int, int]]) -> bool:
        """Exchanges (cost, group out, its components, group back, its components), the cheapest first, as long as each still lowers the cost."""
        moved = False
        for _, i, a, x, b in sorted(best):
            u = float(a * self.size[i] - b * self.size[x])
            v = a * self.labels[i] - b * self.labels[x]
            here = SIZE_COST * float(self.off[to] - self.off[j]) * u + float(v @ (self.off_labels[:, to] - self.off_labels[:, j]))
            most = self.sent[i, j] // a if not b else min(self.sent[i, j] // a, self.sent[x, to] // b)
            c, now = _rounded_best(np.array(here), np.array(2 * (SIZE_COST * u * u + float(v @ v))), most)
            if now < -EPSILON:
                self.move(i, j, to, a * int(c))
                if b:
                    self.move(x, to, j, b * int(c))
                moved = True
        return moved

    def shift(self, j: int, to: int) -> bool:
        """Components of single groups moved on, as many at a time as lower the cost most."""
        slope, along = self.slopes(j, to)
        size = self.size.astype(float)
        _, cost = _rounded_best(SIZE_COST * slope * size + along, 2 * (SIZE_COST * size * size + self.square), self.sent[:, j])
        good = np.flatnonzero(cost < -EPSILON)
        return self._take(j, to, [(c, i, 1, i, 0) for c, i in zip(cost[good].tolist(), good.tolist(), strict=True)])

    def swap(self, j: int, to: int) -> bool:
        """Components of one group exchanged for those of another.

        One for one: each group meets those groups whose sizes bring the splits nearest to their
        quotas, found by search among the sorted sizes; of one size, the groups whose labels gain
        most. So many that the sizes are equal: each group meets the one of the best gain a row.
        """
        out, back = np.flatnonzero(self.sent[:, j]), np.flatnonzero(self.sent[:, to])
        if not len(out) or not len(back):
            return False
        slope, along = self.slopes(j, to)
        by_gain = back[np.lexsort((-along[back], self.size[back]))]
        first = by_gain[np.concatenate(([True], np.diff(self.size[by_gain]) > 0))]  # of each size the one that gains most
        ideal = np.searchsorted(self.size[first], self.size[out] + slope / 2)
        same = np.searchsorted(self.size[first], self.size[out])
        rate_out, rate_back = out[np.argmin(along[out] / self.size[out])], back[np.argmax(along[back] / self.size[back])]
        pairs = [(out, first[np.clip(ideal + d, 0, len(first) - 1)], False) for d in (-1, 0)]
        pairs.append((out, first[np.clip(same, 0, len(first) - 1)], False))
        pairs += [(out, np.full(len(out), rate_back), True), (np.full(len(back), rate_out), back, True)]
        best: list[tuple[float, int, int, int, int]] = []
        for i, x, evenly in pairs:
            s, t = self.size[i], self.size[x]
            g = np.gcd(s, t)
            a, b = (t // g, s // g) if evenly else (np.ones_like(g), np.ones_like(g))
            u = (a * s - b * t).astype(float)
            v = a[:, None] * self.labels[i] - b[:, None] * self.labels[x]
            most = np.minimum(self.sent[i, j] // a, self.sent[x, to] // b)
            _, cost = _rounded_best(SIZE_COST * slope * u + a * along[i] - b * along[x], 2 * (SIZE_COST * u * u + (v * v).sum(1)), most)
            good = np.flatnonzero((cost < -EPSILON) & (i != x))
            best += [tuple(r) for r in zip(cost[good].tolist(), i[good].tolist(), a[good].tolist(), x[good].tolist(), b[good].tolist(), strict=True)]
        return self._take(j, to, best)

    def path(self, j: int, to: int) -> bool:
        """The residual path over all sizes, each as often as there are components, that brings both splits nearest to their quotas."""
        want = float(self.off[j] - self.off[to]) / 2
        sizes, n = np.unique(self.size, return_inverse=True)
        forth, back = (np.bincount(n, self.sent[:, k], len(sizes)).astype(np.int64) for k in (j, to))
        steps = []  # (size, sign, components moved at once): 1, 2, 4 and so on, so that any number can be moved
        for k, size in enumerate(sizes.tolist()):
            for sign, m in ((1, int(forth[k])), (-1, int(back[k]))):
                some = 1
                while m:
                    some = min(some, m)
                    steps.append((size, sign, some))
                    m, some = m - some, 2 * some
        unit = int(np.gcd.reduce([s for s, *_ in steps])) if steps else 0
        if not unit or abs(round(want / unit) * unit - want) >= abs(want) - 1e-6:
            return False
        # in mixed order, so that what goes forth and back stays close to 0 on the way
        steps = [steps[k] for k in np.random.default_rng(0).permutation(len(steps))]
        zero = 8 * max(s for s, *_ in steps)
        via = np.full(2 * zero + 1, -1, np.int32)  # the step that first reaches each net change, after those before it
        via[zero] = len(steps)
        for k, (s, sign, m) in enumerate(steps):
            front = np.flatnonzero(via >= 0) + sign * s * m
            front = front[(front >= 0) & (front < len(via))]
            via[front[via[front] < 0]] = k
        reached = np.flatnonzero(via >= 0)
        at = int(reached[np.argmin(np.abs(reached - zero - want))])
        if abs(at - zero - want) >= abs(want) - 1e-6:
            return False
        while at != zero:
            size, sign, m = steps[via[at]]
            a, b = (j, to) if sign > 0 else (to, j)
            at -= sign * size * m
            for i in np.flatnonzero(self.size == size).tolist():
                some = min(m, int(self.sent[i, a]))
                self.move(i, a, b, some)
                m -= some
        return True

    def settle(self) -> None:
        """Residual paths until none lowers the cost."""
        ways = [(j, to) for j in range(len(self.quota)) for to in range(len(self.quota)) if j != to]
        pairs = [(j, to) for j, to in ways if j < to]
        while True:
            while any([self.shift(*way) for way in ways]):  # noqa: C419
                pass
            if any([self.swap(*pair) for pair in pairs]):  # noqa: C419
                continue
            if self.size_cost() <= self.least + 1e-6 or not any(self.path(*pair) for pair in pairs):
                return

    def kick(self, rng: np.random.Generator) -> None:
        """A few components moved at random, so that paths over three splits at once come into reach."""
        for _ in range(int(rng.integers(1, 4))):
            i, (j, to) = int(rng.integers(len(self.size))), rng.choice(len(self.quota), 2, replace=False).tolist()
            if self.sent[i, j]:
                self.move(i, j, to, 1)


def allocate(groups: list[tuple[int, int]], shares: list[float], labels: np.ndarray | None = None) -> list[list[int]]:
    """Whole numbers of components by group and split, from (size, components) of each group.

    labels: rows of each label that a component of the group has. The flow starts with the
    floors of the proportional one, which is the least-cost flow of parts, and the rest placed
    largest first; it is then sent along residual paths until none lowers the cost: any number
    of components of a group to another split, exchanges between two groups, and paths over all
    sizes. Costs are the squared deviations of the splits' sizes from their quotas, and,
    SIZE_COST times less, those of their labels. As components can't be cut, the least of all
    costs is a subset sum: while sizes are off their rounded quotas, the flow is disturbed and
    settled again, KICKS times, and the best one kept.
    """
    if not groups:
        return []
    flow = _Flow(groups, shares, labels)
    flow.fill()
    flow.settle()
    best, least = flow.sent.copy(), flow.cost()
    rng = np.random.default_rng(0)
    for _ in range(KICKS if len(shares) > 2 else 0):
        if ((flow.size @ best - flow.quota) ** 2).sum() <= flow.least + 1e-6:
            break
        flow.sent = best.copy()
        flow.measure()
        flow.kick(rng)
        flow.settle()
        if flow.cost() < least - EPSILON:
            best, least = flow.sent.copy(), flow.cost()
    return best.tolist()


def _ranked(rows: DataFrame, keys: list[str], at: Column, order: list[Column], name: str) -> DataFrame:
    """rows with their number from 0 within keys by at (0 to 1) and order; at cuts a hot key to buckets of RANK_ROWS rows or so."""
    count = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    cut = rows.join(count, keys).withColumn("_bucket", F.floor(at * F.ceil(F.col("_n") / RANK_ROWS)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_m")).select(*keys, "_bucket", F.coalesce(F.sum("_m").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return cut.join(base, [*keys, "_bucket"]).withColumn(name, F.col("_base") + F.row_number().over(within) - 1).drop("_bucket", "_base")


def assign(sessions: DataFrame, aliases: DataFrame, proportions: dict[str, float] | None = None, seed: int = 7) -> DataFrame:
    """(session_key, split, person): every distinct session once, persons whole.

    Labels of the profile are montage kinds. Proportions must sum to 1. Persons of whom one
    session_key is given are dealt together. An empty table gives an empty one.

    Components of one size and profile are a bundle; the driver sees the bundles of one size and
    main label as one group, with true sizes and their mean labels: n distinct sizes need at
    least n * n / 2 sessions, so there are at most sqrt(2 * sessions) sizes by main labels.
    Within a group members are dealt in an order in which each bundle is spread evenly.
    """
    proportions = proportions or PROPORTIONS
    names = list(proportions)
    rows = persons(sessions, aliases)
    distinct = materialize(rows.groupBy("session_key").agg(F.min("person").alias("person"), F.min("label").alias("label"), F.max("person").alias("other")), "sessions")
    if not distinct.where("person <> other").isEmpty():
        shared = rows.join(distinct.select("session_key", F.col("person").alias("least")), "session_key").where("person <> least")
        tied = connected_components(shared.select(F.col("least").alias("a"), F.col("person").alias("b")))
        distinct = distinct.join(tied, distinct["person"] == tied["node"], "left").select("session_key", F.coalesce("root", "person").alias("person"), "label")
    by_label = distinct.groupBy("person", F.coalesce("label", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    labels = F.array_sort(F.collect_list(F.struct("label", "n")))
    components = by_label.groupBy("person").agg(F.sum("n").alias("size"), labels.alias("labels"), F.max_by("label", F.struct("n", "label")).alias("main"))
    components = materialize(components.withColumn("profile", F.to_json("labels")), "components")
    groups = components.groupBy("size", "main").agg(F.count(F.lit(1)).alias("count")).toArrow().sort_by([("size", "ascending"), ("main", "ascending")]).to_pylist()
    has = components.select("size", "main", F.inline("labels")).groupBy("size", "main", "label").agg(F.sum("n").alias("n")).toArrow().to_pylist()
    place = {(r["size"], r["main"]): i for i, r in enumerate(groups)}
    kinds = {label: i for i, label in enumerate(sorted({r["label"] for r in has}))}
    each = np.zeros((len(groups), len(kinds)))
    for r in has:
        i = place[r["size"], r["main"]]
        each[i, kinds[r["label"]]] = r["n"] / groups[i]["count"]
    sent = allocate([(r["size"], r["count"]) for r in groups], list(proportions.values()), each)
    upto = np.cumsum(np.array(sent, np.int64).reshape(-1, len(names)), 1)
    told = pa.table({"size": pa.array([r["size"] for r in groups], pa.int64()), "main": pa.array([r["main"] for r in groups], pa.string()), "upto": pa.array(upto.tolist(), pa.list_(pa.int64()))})
    limits = sessions.sparkSession.createDataFrame(told)
    hashed = components.select("person", "size", "main", "profile", F.xxhash64(F.lit(seed), "person").alias("hash"))
    bundled = _ranked(hashed, ["size", "main", "profile"], F.pmod("hash", F.lit(1 << 20)) / F.lit(float(1 << 20)), [F.col("hash"), F.col("person")], "_rank")
    spread = bundled.withColumn("_at", (F.col("_rank") + 0.5) / F.col("_n")).drop("_n", "_rank")
    ranked = _ranked(spread, ["size", "main"], F.col("_at"), [F.col("_at"), F.col("hash"), F.col("person")], "rank")
    to = F.size(F.filter("upto", lambda u: u <= F.col("rank"))) + 1
    dealt = ranked.join(limits, ["size", "main"]).select("person", F.element_at(F.array(*[F.lit(x) for x in names]), to).alias("split"))
    return distinct.join(dealt, "person").select("session_key", "split", "person")


def reached(assigned: DataFrame, proportions: dict[str, float] | None = None) -> DataFrame:
    """Sessions and share of each split, beside its target."""
    targets = assigned.sparkSession.createDataFrame(list((proportions or PROPORTIONS).items()), "split string, target double")
    counts = assigned.groupBy("split").agg(F.count(F.lit(1)).alias("sessions"), F.count_distinct("person").alias("persons"))
    total = F.sum("sessions").over(Window.partitionBy(F.lit(1)))  # of one row a split
    joined = targets.join(counts, "split", "left").select("split", "target", F.coalesce("sessions", F.lit(0)).alias("sessions"), F.coalesce("persons", F.lit(0)).alias("persons"))
    return joined.withColumn("share", F.when(total > 0, F.col("sessions") / total))
