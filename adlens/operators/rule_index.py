"""Many bidding rules at once: thresholds looked up instead of every rule tried.

The thresholds of a metric, sorted, cut its values into places: the gaps
between neighbours and the thresholds themselves.  A rule that joins simple
comparisons with ``and`` is then one range of places per metric, and a row is one
place per metric, found by binary search.

Each rule is entered under the metric whose range is narrowest.  The range is
written as at most two nodes per level of a binary tree over the places; a place
lies under one node per level.  So a row finds the rules whose range holds it by
an equality join on its nodes, once each, and meets no rule whose range it is
outside of.  The ranges of the other metrics are compared as places.

Rules of any other form (``or``, ``not``, arithmetic, ``!=``) are evaluated on each row, in
the same pass over the report.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tables of rules up to this many rows are broadcast; larger ones are shuffled.  They come from
# the rules document alone, so they do not grow with the report.
BROADCAST_NODES = 1_000_000
# The metric's number stands above the node's in a key.
_METRIC_BITS = 40

FLIPPED = {"<": ">", "<=": ">=", ">": "<", ">=": "<=", "==": "=="}


def places(thresholds: list[float], op: str, value: float) -> tuple[int, int]:
    """The range [first, end) of places where ``metric op value`` holds; ``value`` is one of the sorted thresholds."""
    at = 2 * bisect_left(thresholds, value) + 1
    last = 2 * len(thresholds) + 1
    return {"<": (0, at), "<=": (0, at + 1), ">": (at + 1, last), ">=": (at, last), "==": (at, at + 1)}[op]


def tree_nodes(first: int, end: int, depth: int) -> list[int]:
    """The fewest nodes of a binary tree over 2^depth places (root 1) that hold exactly [first, end)."""
    lo, hi, out = first + (1 << depth), end + (1 << depth), []
    while lo < hi:
        if lo & 1:
            out.append(lo)
            lo += 1
        if hi & 1:
            hi -= 1
            out.append(hi)
        lo, hi = lo >> 1, hi >> 1
    return out


def place_of(value: Column, thresholds: list[float]) -> Column:
    """A value's place: twice the thresholds below it, and one more where it equals the next."""
    known = F.split(F.lit(",".join(map(repr, thresholds))), ",").cast("array<double>")  # a constant, folded once
    steps = [1 << k for k in reversed(range(len(thresholds).bit_length()))]

    def further(below: Column, step: Column) -> Column:
        return F.when(F.get(known, below + step - 1) < value, below + step).otherwise(below)

    def finish(below: Column) -> Column:
        return below * 2 + F.coalesce(F.get(known, below) == value, F.lit(False)).cast("int")

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further, finish)


class RuleIndex:
    """Ranges and tree nodes of rules given as (rule number, [(metric, operator, value)])."""

    def __init__(self, simple: list[tuple[int, list[tuple[str, str, float]]]], metrics: tuple[str, ...]):
        seen: dict[str, set[float]] = {m: set() for m in metrics}
        for _, comparisons in simple:
            for metric, _, value in comparisons:
                seen[metric].add(value)
        self.thresholds = {m: sorted(v) for m, v in seen.items() if v}
        self.depth = {m: (2 * len(t)).bit_length() for m, t in self.thresholds.items()}
        self._number = {m: k for k, m in enumerate(metrics)}
        at = {(m, op, v): places(t, op, v) for m, t in self.thresholds.items()
              for op, v in {(op, v) for _, cs in simple for name, op, v in cs if name == m}}
        self.ranges: dict[int, dict[str, tuple[int, int]]] = {}
        self.nodes: list[tuple[int, int]] = []
        shifts = set()
        for rule, comparisons in simple:
            box = {}
            for c in comparisons:
                first, end = box.get(c[0], (0, 2 * len(self.thresholds[c[0]]) + 1))
                box[c[0]] = max(first, at[c][0]), min(end, at[c][1])
            if any(first >= end for first, end in box.values()):
                continue  # contradicts itself: never fires
            self.ranges[rule] = box
            metric = min(box, key=lambda m: (box[m][1] - box[m][0]) / (2 * len(self.thresholds[m]) + 1))
            for node in tree_nodes(*box[metric], self.depth[metric]):
                self.nodes.append((self._number[metric] << _METRIC_BITS | node, rule))
                shifts.add((metric, self.depth[metric] + 1 - node.bit_length()))
        self.shifts = sorted(shifts)

    def keys(self, place: dict[str, Column]) -> list[Column]:
        """The nodes above a row's places, on the levels where rules are entered."""
        return [F.shiftright(place[m].cast("bigint") + F.lit(1 << self.depth[m]), s) + F.lit(self._number[m] << _METRIC_BITS).cast("bigint")
                for m, s in self.shifts]


def _bounded(table: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(table) if rows <= BROADCAST_NODES else table


def fired_by_index(frame: DataFrame, index: RuleIndex, tested: list[tuple[int, Column]],
                   payloads: list[tuple], payload_type: str, metric_column: str = "_m_{}") -> DataFrame:
    """Rows x firing rules as ``r``; the rules of one row come in no set order.

    ``tested`` are the (rule number, predicate) that have no range; ``payloads`` are
    (rule number, *fields) of all rules, and ``payload_type`` their type.  Equal rows fire separately.
    """
    spark = frame.sparkSession
    metrics = list(index.thresholds)
    frame = frame.withColumns({f"_place_{m}": place_of(F.col(metric_column.format(m)), index.thresholds[m]) for m in metrics})
    entry = "struct<key:bigint,rule:int>"
    found = [F.struct(k.alias("key"), F.lit(None).cast("int").alias("rule")).cast(entry)
             for k in index.keys({m: F.col(f"_place_{m}") for m in metrics})]
    found += [F.when(p, F.struct(F.lit(None).cast("bigint").alias("key"), F.lit(n).alias("rule"))).cast(entry) for n, p in tested]
    parts = [F.filter(F.array(*found[a:a + 200]), lambda x: x.isNotNull()) for a in range(0, len(found), 200)]
    probes = frame.select("*", F.explode(F.concat(*parts)).alias("_probe"))

    nodes = spark.createDataFrame(index.nodes, "_node bigint, _node_rule int", verifySchema=False)
    without_range = {n for n, _ in tested}
    rows, unbounded = [], {m: (0, 2 * len(t) + 1) for m, t in index.thresholds.items()}
    for number, *fields in payloads:
        if number in index.ranges or number in without_range:
            box = {**unbounded, **index.ranges.get(number, {})}
            rows.append((number, tuple(fields), *[edge for m in metrics for edge in box[m]]))
    edges = "".join(f", _first_{m} int, _end_{m} int" for m in metrics)
    table = spark.createDataFrame(rows, f"_rule int, r {payload_type}{edges}", verifySchema=False)

    met = probes.join(_bounded(nodes, len(index.nodes)), F.col("_probe.key") == F.col("_node"), "left")
    met = met.withColumn("_met", F.coalesce(F.col("_probe.rule"), F.col("_node_rule"))).filter(F.col("_met").isNotNull())
    holds = F.lit(True)
    for m in metrics:
        holds = holds & (F.col(f"_place_{m}") >= F.col(f"_first_{m}")) & (F.col(f"_place_{m}") < F.col(f"_end_{m}"))
    return met.join(_bounded(table, len(rows)), (F.col("_met") == F.col("_rule")) & holds)
