"""Entropy trees with missing values (MOD-04..06, MOD-13).

Inputs are binned once: an interval input into equal-width bins between its
least and greatest value, a nominal one into its levels.  A missing value (NULL,
NaN, infinite, or a level the training rows do not have) has a bin of its own.
Rows are then collapsed to counts of (bins, label) patterns, and the tree grows
level by level: one aggregation gives the counts per (node, input, bin) of all
open nodes, from which the best binary split of every node is read.  Missing
rows of a split go to the child with more other rows, and count there.

Only histograms reach the driver: open nodes x bins numbers a level, whatever
the number of rows.  Scoring is a chain of lookups in the node table.
"""

from __future__ import annotations

import json
import math
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.models import levels_of
from tessera.session import materialize

MOST_CELLS = 2_000_000      # counts of (node, input, bin) that one level may send to the driver
PLACES = 9                  # gains are compared to so many decimals, so equal ones tie


@dataclass
class Binned:
    """An input and its bins: ``lo`` and ``width`` of an interval one, the ``levels`` of a nominal one."""

    name: str
    lo: float | None = None
    width: float | None = None
    bins: int = 0
    levels: list[str] = field(default_factory=list)

    def bin(self) -> Column:
        """0-based bin of the input, NULL where it is missing."""
        x = F.col(f"`{self.name}`")
        if self.width is None:
            at = F.array_position(F.array(*[F.lit(v) for v in self.levels]).cast("array<string>"), x.cast("string"))
            return F.when(at > 0, (at - 1).cast("int"))
        x = x.cast("double")
        at = F.floor((x - self.lo) / self.width) if self.width else F.lit(0)
        known = x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
        return F.when(known, F.greatest(F.lit(0), F.least(F.lit(self.bins - 1), at)).cast("int"))


@dataclass
class Node:
    """A node's training counts and, unless it is a leaf, its split: the bins that go left
    (``left_bins``), as text too, and where missing values go."""

    node: int
    n: int
    n_event: int
    input: str | None = None
    cut: float | None = None
    left_levels: str | None = None
    missing_left: bool | None = None
    gain: float | None = None
    left_bins: list[int] | None = None

    @property
    def depth(self) -> int:
        return self.node.bit_length() - 1


def bin_inputs(df: DataFrame, interval: list[str], nominal: list[str], bins: int, most_levels: int = 1000) -> list[Binned]:
    """Bins of all inputs, from one aggregation over the interval ones and the levels of the nominal
    ones (beyond ``most_levels`` an error)."""
    out = []
    if interval:
        x = {c: F.col(f"`{c}`").cast("double") for c in interval}
        ok = {c: F.when(~F.isnan(v) & (F.abs(v) != float("inf")), v) for c, v in x.items()}
        r = df.agg(*[f(v).alias(f"{k}{i}") for i, v in enumerate(ok.values()) for k, f in (("lo", F.min), ("hi", F.max))]).first()
        for i, c in enumerate(interval):
            lo, hi = r[f"lo{i}"] or 0.0, r[f"hi{i}"] or 0.0
            out.append(Binned(c, lo, (hi - lo) / bins, bins))
    levels = levels_of(df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in nominal]), nominal, most_levels)
    return out + [Binned(c, levels=levels[c], bins=len(levels[c])) for c in nominal]


def entropy_mass(n: int, k: int) -> float:
    """n times the entropy, in nats, of n rows with k events."""
    return sum(-c * math.log(c / n) for c in (k, n - k) if c)


def best_split(node: Node, hist: dict[int, dict[int | None, tuple[int, int]]], inputs: list[Binned], min_leaf: int) -> None:
    """Gives ``node`` the split of most gain, if there is one; ``hist`` has (n, events) per input and bin.

    Levels of a nominal input stand in the order of their event rate, so the best of all
    their two-way splits is among the cuts of that order.  Equal gains: the earlier input,
    then the earlier cut.
    """
    whole = entropy_mass(node.n, node.n_event)
    for i, spec in enumerate(inputs):
        cells = hist.get(i, {})
        gone_n, gone_k = cells.get(None, (0, 0))
        seen = sorted(b for b in cells if b is not None)
        if spec.width is None:
            seen.sort(key=lambda b: cells[b][1] / cells[b][0])       # stable: ties stay in level order
        left_n = left_k = 0
        for at, b in enumerate(seen[:-1]):
            left_n, left_k = left_n + cells[b][0], left_k + cells[b][1]
            rest_n = node.n - gone_n - left_n
            missing_left = left_n >= rest_n
            n, k = (left_n + gone_n, left_k + gone_k) if missing_left else (left_n, left_k)
            if min(n, node.n - n) < min_leaf:
                continue
            gain = round((whole - entropy_mass(n, k) - entropy_mass(node.n - n, node.n_event - k)) / node.n / math.log(2), PLACES)
            if gain > 0 and gain > (node.gain or 0.0):
                node.input, node.gain, node.missing_left = spec.name, gain, missing_left
                if spec.width is None:
                    own = sorted(seen[:at + 1])
                    node.cut, node.left_levels = None, ",".join(spec.levels[j] for j in own)
                    unseen = set(range(spec.bins)) - set(seen)        # as good as missing here
                    node.left_bins = sorted({*own, *unseen}) if missing_left else own
                else:
                    node.cut, node.left_levels = spec.lo + (b + 1) * spec.width, None
                    node.left_bins = list(range(b + 1))


class EntropyTree:
    """A fitted tree: the bins of its inputs and its nodes (root 1, children 2i and 2i + 1)."""

    def __init__(self, inputs: list[Binned], nodes: list[Node]):
        self.inputs, self.nodes = inputs, nodes

    def table(self, spark: SparkSession) -> DataFrame:
        """MOD-06, the node details: one row a node; ``input`` and what follows is NULL for leaves.
        ``cut`` (interval: below it goes left) or ``left_levels`` (nominal) is the split."""
        rows = [(t.node, t.node // 2 or None, t.depth, t.n, t.n_event, t.n_event / t.n,
                 entropy_mass(t.n, t.n_event) / t.n / math.log(2), t.input, t.cut, t.left_levels,
                 None if t.input is None else "left" if t.missing_left else "right", t.gain) for t in self.nodes]
        return spark.createDataFrame(rows, "node LONG, parent LONG, depth INT, n LONG, n_event LONG, p_event DOUBLE, "
                                           "entropy DOUBLE, input STRING, cut DOUBLE, left_levels STRING, "
                                           "missing_to STRING, gain DOUBLE")

    def _step(self, rows: DataFrame, depth: int) -> DataFrame:
        """Rows of split nodes of this depth move to a child."""
        number = {b.name: i for i, b in enumerate(self.inputs)}
        splits = [(t.node, number[t.input], t.left_bins, t.missing_left) for t in self.nodes if t.depth == depth and t.input]
        if not splits:
            return rows
        table = rows.sparkSession.createDataFrame(splits, "__node LONG, __input INT, __left ARRAY<INT>, __missing BOOLEAN")
        at = F.element_at("__bins", F.col("__input") + 1)
        left = F.when(at.isNull(), F.col("__missing")).otherwise(F.array_contains("__left", at))
        moved = 2 * F.col("__node") + F.when(left, 0).otherwise(1)
        # at most 2 ** depth rows
        return (rows.join(F.broadcast(table), "__node", "left")
                .withColumn("__node", F.when(F.col("__input").isNull(), F.col("__node")).otherwise(moved))
                .drop("__input", "__left", "__missing"))

    def _rooted(self, df: DataFrame) -> DataFrame:
        return df.withColumns({"__bins": F.array(*[b.bin() for b in self.inputs]).cast("array<int>"),
                               "__node": F.lit(1).cast("long")})

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with ``node``, the leaf a row falls into, and ``score``, its training event rate.  Every row is
        scored: missing values and unknown levels take the way of the missing."""
        rows = self._rooted(df)
        for d in range(max(t.depth for t in self.nodes)):
            rows = self._step(rows, d)
        rates = df.sparkSession.createDataFrame([(t.node, t.n_event / t.n) for t in self.nodes if not t.input],
                                                "__node LONG, score DOUBLE")
        return rows.join(F.broadcast(rates), "__node").withColumnRenamed("__node", "node").drop("__bins")

    def save(self, spark: SparkSession, path: str) -> None:
        """MOD-13: the score code, one JSON row a node and one an input."""
        rows = [("input", i, json.dumps(asdict(b))) for i, b in enumerate(self.inputs)]
        rows += [("node", i, json.dumps(asdict(t))) for i, t in enumerate(self.nodes)]
        spark.createDataFrame(rows, "kind STRING, position INT, value STRING").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> EntropyTree:
        rows = spark.read.parquet(path).orderBy("kind", "position").collect()      # one row a node
        of = lambda kind, make: [make(**json.loads(r.value)) for r in rows if r.kind == kind]
        return cls(of("input", Binned), of("node", Node))


def grow(df: DataFrame, label: str, interval: list[str], nominal: list[str], max_depth: int, min_leaf: int,
         bins: int = 100) -> EntropyTree:
    """MOD-04: an unpruned binary entropy tree of at most ``max_depth`` levels of splits, children of at least
    ``min_leaf`` rows.

    ``label`` is 0 or 1; rows without it are left out.  Inputs are tried in the order ``interval``,
    then ``nominal``.  A table without labelled rows is an error.
    """
    df = df.filter(F.col(label).isNotNull())
    inputs = bin_inputs(df, interval, nominal, bins)
    tree = EntropyTree(inputs, [])
    y = F.col(label).cast("long")
    rows = materialize(tree._rooted(df).groupBy("__bins", "__node").agg(F.count("*").alias("__n"), F.sum(y).alias("__k")))
    total = rows.agg(F.sum("__n").alias("n"), F.sum("__k").alias("k")).first()
    if not total.n:
        raise ValueError(f"no row has {label}")
    tree.nodes.append(Node(1, total.n, total.k))
    open_ = [tree.nodes[0]]
    for depth in range(max_depth):
        open_ = [t for t in open_ if 0 < t.n_event < t.n]
        if not open_:
            break
        if len(open_) * sum(b.bins + 1 for b in inputs) > MOST_CELLS:
            raise ValueError(f"level {depth} has over {MOST_CELLS} counts; use fewer bins or less depth")
        wanted = df.sparkSession.createDataFrame([(t.node,) for t in open_], "__node LONG")
        cells = rows.join(F.broadcast(wanted), "__node").select("__node", "__n", "__k", F.posexplode("__bins").alias("i", "b"))
        hist: dict[int, dict] = {}
        for r in cells.groupBy("__node", "i", "b").agg(F.sum("__n").alias("n"), F.sum("__k").alias("k")).collect():
            hist.setdefault(r["__node"], {}).setdefault(r.i, {})[r.b] = (r.n, r.k)
        children = []
        for t in open_:
            own = hist.get(t.node, {})
            best_split(t, own, inputs, min_leaf)
            if t.input:
                cells_of = own[next(i for i, b in enumerate(inputs) if b.name == t.input)]
                goes = lambda b, t=t: t.missing_left if b is None else b in t.left_bins
                n, k = (sum(c[x] for b, c in cells_of.items() if goes(b)) for x in (0, 1))
                children += [Node(2 * t.node, n, k), Node(2 * t.node + 1, t.n - n, t.n_event - k)]
        if not children:
            break
        tree.nodes += children
        rows = tree._step(rows, depth)
        open_ = children
    return tree
