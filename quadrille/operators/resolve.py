"""Entity resolution: pairs (x, y) that stand for one thing.

Atoms give candidate pairs, a rule intersects its atoms, guards drop what is known or denied, and a bounded closure follows. Pairs are symmetric.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrille import terms
from quadrille.operators.ranking import with_position
from quadrille.plans import patterns
from quadrille.store import written

#: Rows that a fuzzy comparison looks at around each, and the degree that means "same first letter". Fixed values.
WINDOW, FIRST_LETTER = 100, 19

#: Pairs that a task makes, about: values with more are shared out. Fixed value.
PAIRS_A_TASK = 4_000_000

#: Rows of a side that are sent to every executor; more are shuffled. Fixed value.
FEW = 250_000

#: Name ladder: level of x, level of y, levels that neither node may have (the second counts more for x). Fixed values.
LADDER = [
    ("C3", "C3", "XX", "XX"), ("RC3", "C3", "XX", "XX"), ("C2", "C2", "XX", "C3"), ("C1", "C1", "XX", "C2"), ("RC1", "C1", "XX", "XX"), ("B3", "B3", "C1", "XX"),
    ("B2", "B2", "C1", "B3"), ("B1", "B1", "C1", "B2"), ("RB1", "B1", "C1", "XX"), ("A3", "A3", "B1", "XX"), ("A2", "A2", "B1", "A3"), ("A1", "A1", "B1", "A2"),
]


def swapped(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("y").alias("x"), F.col("x").alias("y"))


def both_ways(pairs: DataFrame) -> DataFrame:
    return pairs.unionByName(swapped(pairs)).distinct()


def same_value(values: DataFrame) -> DataFrame:
    """Pairs x != y of rows (x, value) with one value. A value that very many share gives very many pairs: that is what the rule says; ``representatives`` gives a row each."""
    other = values.select(F.col("x").alias("y"), "value")
    return values.join(other, "value").where("x != y").select("x", "y").distinct()


def agreeing(rows: DataFrame, differ: tuple[str, ...] = (), stored: bool = False) -> DataFrame:
    """Pairs x != y of rows (x, value, *differ) with one value, and other ``differ`` columns each. The rows have no repeats, unless they are ``stored``: read from a table at little cost.

    Rows whose value no other has are left out first, where they are many. Two resources of one row each meet once at most, so their pairs leave the join as they are; only pairs with
    a resource of several rows are made distinct. So what is shuffled grows with the rows, not with the square of a value's rows. Where there are many pairs, tasks are dealt by pairs:
    a value with many goes to several tasks, which share out its x.
    """
    conf = rows.sparkSession.conf
    rows = rows if stored else written(rows, "agreeing")
    sizes = written(rows.groupBy(F.xxhash64("value").alias("hash")).agg(F.count(F.lit(1)).alias("rows")), "sizes")  # two values of one hash only count as shared
    square = F.col("rows").cast("double") ** 2
    total, most, n, alone, shared = (x or 0 for x in sizes.agg(F.sum(square), F.max(square), F.sum("rows"), F.count_if(F.col("rows") == 1), F.count_if(F.col("rows") > 1)).first())
    pruned = 2 * alone > n
    if pruned:
        several = sizes.where("rows > 1").select("hash")
        rows = rows.withColumn("hash", F.xxhash64("value")).join(F.broadcast(several) if shared <= FEW else several, "hash", "left_semi").drop("hash")
    if pruned or stored:
        rows = written(rows.distinct() if stored else rows, "agreeing")
    tasks = max(int(total / PAIRS_A_TASK), int(conf.get("spark.sql.shuffle.partitions")))
    large = sizes.where(square > PAIRS_A_TASK).select("hash", F.ceil(square / PAIRS_A_TASK).cast("int").alias("shares")) if most > PAIRS_A_TASK else None
    if large is not None and total / PAIRS_A_TASK <= FEW:  # there are no more of them than that
        large = F.broadcast(large)

    def shared_out(side: DataFrame, *shares: Column) -> DataFrame:
        return side.withColumn("hash", F.xxhash64("value")).join(large, "hash", "left").withColumn("share", *shares).drop("hash", "shares").repartition(tasks, "value", "share")

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        on = ["value"]
        if total > PAIRS_A_TASK and large is None:
            left, right = left.repartition(tasks, "value"), right.repartition(tasks, "value")
        elif large is not None:
            share = F.coalesce("shares", F.lit(1))
            left, right = shared_out(left, F.pmod(F.xxhash64("x"), share).cast("int")), shared_out(right, F.explode(F.sequence(F.lit(0), share - 1)))
            on.append("share")
        other = right.select(F.col("x").alias("y"), *on, *(F.col(c).alias(f"{c}_y") for c in differ))
        return left.join(other, on).where(reduce(lambda a, c: a & (F.col(c) != F.col(f"{c}_y")), differ, F.col("x") != F.col("y"))).select("x", "y")

    several = written(rows.groupBy("x").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select("x", F.lit(True).alias("several")), "several")
    n = several.count()
    if not n:
        return met(rows, rows)
    rows = written(rows.join(F.broadcast(several) if n <= FEW else several, "x", "left").withColumn("several", F.coalesce("several", F.lit(False))), "agreeing")
    lone, several = rows.where("not several"), rows.where("several")
    mixed = met(several, lone)
    return met(lone, lone).unionByName(met(several, several).unionByName(mixed).unionByName(swapped(mixed)).distinct())


def hash_shared(rows: DataFrame, value: Column) -> DataFrame:
    """The ``rows`` whose value another row has, too, or one of its hash."""
    return rows.withColumn("__hash", F.xxhash64(value)).withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy("__hash"))).where("__n > 1").drop("__hash", "__n")


def shared(rows: DataFrame) -> DataFrame:
    """Rows (x, value) as ``hash_shared`` leaves them."""
    return written(hash_shared(rows, F.col("value")).select("x", "value"), "shared")


def grouped(rows: DataFrame) -> DataFrame | None:
    """(x, value) of ``shared`` rows without repeats, as groups of two and more: the value is the least x of the group. None if an x is in several: then what agrees isn't in groups."""
    spread = Window.partitionBy("value")
    groups = written(rows.withColumn("n", F.count(F.lit(1)).over(spread)).withColumn("value", F.min("x").over(spread)).where("n > 1").select("x", "value"), "groups")
    return groups if groups.groupBy("x").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty() else None


def within(rows: DataFrame, root: str = "root") -> DataFrame:
    """Every row with every row of its ``root``, itself too: the other one's columns end in ``_y``. Where there are many pairs, tasks are dealt by pairs, as in ``agreeing``."""
    square = F.col("rows").cast("double") ** 2
    sizes = rows.groupBy(root).agg(F.count(F.lit(1)).alias("rows"))
    total, most = (n or 0 for n in sizes.agg(F.sum(square), F.max(square)).first())
    tasks = max(int(total / PAIRS_A_TASK), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    left, right, on = rows, rows, [root]
    if most > PAIRS_A_TASK:
        large = sizes.where(square > PAIRS_A_TASK).select(root, F.ceil(square / PAIRS_A_TASK).cast("int").alias("shares"))
        side = rows.join(F.broadcast(large) if total / PAIRS_A_TASK <= FEW else large, root, "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
        left = side.withColumn("share", F.pmod(F.xxhash64("x"), F.col("shares")).cast("int")).drop("shares")
        right = side.withColumn("share", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).drop("shares")
        on.append("share")
    if total > PAIRS_A_TASK:
        left, right = left.repartition(tasks, *on), right.repartition(tasks, *on)
    return left.join(right.withColumnsRenamed({c: f"{c}_y" for c in rows.columns if c != root}), on).drop("share")


class Find(NamedTuple):
    """Groups (x, value) of ``grouped``, what found them, and its place in the order of finds."""

    at: int
    name: str
    groups: DataFrame


@dataclass(eq=False)
class Block:
    """Resources that groups of one or several finds put together: the finds in order, classes (node, root), and what each resource is in (x, root, v0, ...), a column a find."""

    finds: list[Find]
    roots: DataFrame
    members: DataFrame

    @classmethod
    def of(cls, finds: list[Find]) -> Block:
        """The finds of one block. Resources that are in the same groups go through the classes' rounds as one."""
        if not finds[1:]:
            groups = finds[0].groups
            return cls(finds, groups.select(F.col("x").alias("node"), F.col("value").alias("root")), groups.select("x", F.col("value").alias("root"), F.col("value").alias("v0")))
        ins = [f"v{k}" for k in range(len(finds))]
        sides = [f.groups.withColumnRenamed("value", v) for v, f in zip(ins, finds, strict=True)]
        held = reduce(lambda a, b: a.join(b, "x", "full"), sides).withColumn("twin", F.min("x").over(Window.partitionBy(*ins)))
        held = written(held, "twins")
        one = written(held.where("x = twin").select("x", *ins), "twins")
        edges = [representatives(one.where(F.col(v).isNotNull()).select("x", F.col(v).alias("value"))) for v in ins]
        labels = classes(reduce(DataFrame.unionByName, edges).distinct()).withColumnRenamed("node", "twin")
        members = written(held.join(labels, "twin", "left").select("x", F.coalesce("root", "twin").alias("root"), *ins), "members")
        return cls(finds, members.select(F.col("x").alias("node"), "root"), members)

    def close(self, name: str, at: int) -> None:
        """From now on all of a class are the same; pairs that no find has are found by ``name``."""
        if self.finds[1:] and self.finds[-1].name != name:
            self.finds.append(Find(at, name, self.roots.select(F.col("node").alias("x"), F.col("root").alias("value"))))
            self.members = self.members.withColumn(f"v{len(self.finds) - 1}", F.col("root"))

    def _found(self) -> Column:
        """The first find that has a pair of ``within``."""
        return F.coalesce(*(F.when(F.col(f"v{k}") == F.col(f"v{k}_y"), F.lit(f.name)) for k, f in enumerate(self.finds)))

    def pairs(self) -> DataFrame:
        """(x, y, rule), both directions: each pair once, by what found it first."""
        met = within(self.members).where("x != x_y").select("x", F.col("x_y").alias("y"), self._found().alias("rule"))
        return met.where(F.col("rule").isNotNull())

    def counts(self) -> DataFrame:
        """(rule, pairs, resources) of ``pairs``. Resources that are in the same groups count together, so no pairs of theirs are made."""
        if not self.finds[1:]:
            sizes = self.members.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
            return sizes.agg(F.sum(F.col("n") * (F.col("n") - 1)).alias("pairs"), F.sum("n").alias("resources")).select(F.lit(self.finds[0].name).alias("rule"), "pairs", "resources")
        ins = [f"v{k}" for k in range(len(self.finds))]
        alike = written(self.members.groupBy("root", *ins).agg(F.min("x").alias("x"), F.count(F.lit(1)).alias("n")), "alike")
        met = within(alike).withColumn("rule", self._found()).withColumn("pairs", F.col("n") * (F.col("n_y") - F.when(F.col("x") == F.col("x_y"), 1).otherwise(0)))
        each = met.where("rule is not null and pairs > 0").groupBy("x", "rule").agg(F.sum("pairs").alias("pairs"), F.max("n").alias("n"))
        return each.groupBy("rule").agg(F.sum("pairs").alias("pairs"), F.sum("n").alias("resources"))


def representatives(values: DataFrame) -> DataFrame:
    """The same classes as ``same_value`` with one edge a row, from each x to the least of its value: enough for closures and canonical names, and linear in the rows."""
    least = values.groupBy("value").agg(F.min("x").alias("y"))
    return values.join(least, "value").where("x != y").select("x", "y").distinct()


def data_property(quads: DataFrame, cls: str, predicate: str) -> DataFrame:
    """(x, value) for instances of a class."""
    return patterns.match(quads, ("?x", terms.TYPE, cls), ("?x", predicate, "?value")).select("x", "value")


def through_equivalence(values: DataFrame, edges: DataFrame) -> DataFrame:
    """(x, value) where a value is also every resource it is the same as."""
    more = values.join(edges.select(F.col("x").alias("value"), F.col("y").alias("same")), "value").select("x", F.col("same").alias("value"))
    return values.select("x", "value").unionByName(more).distinct()


def rule(*atoms: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """Pairs that every atom gives. Atoms that are functions are only made if pairs are left."""
    pairs: DataFrame | None = None
    for atom in atoms:
        if callable(atom):
            if pairs is not None and pairs.isEmpty():
                return pairs
            atom = atom()
        pairs = atom if pairs is None else pairs.join(atom, ["x", "y"], "left_semi")
    if pairs is None:
        raise ValueError("a rule needs an atom")
    return pairs.distinct()


def guarded(pairs: DataFrame, known: DataFrame | None = None, different: DataFrame | None = None, whole: bool = False) -> DataFrame:
    """Both directions of ``pairs`` without loops, pairs that are known already and pairs said to differ (in either direction). ``whole``: ``pairs`` and ``known`` have both directions and no loops."""
    out = pairs if whole else both_ways(pairs.where("x != y"))
    if known is not None:
        out = out.join(known.select("x", "y") if whole else both_ways(known.select("x", "y")), ["x", "y"], "left_anti")
    if different is not None:
        out = out.join(both_ways(different.select("x", "y")), ["x", "y"], "left_anti")
    return out


def reflexive(quads: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(missing loops of typed resources, loops of resources that aren't typed any more)."""
    typed = patterns.scan(quads, "?x", terms.TYPE, "?t").select("x").distinct()
    loops = edges.where("x = y").select("x")
    return typed.join(loops, "x", "left_anti").select("x", F.col("x").alias("y")), loops.join(typed, "x", "left_anti").select("x", F.col("x").alias("y"))


def twins(edges: DataFrame, whole: bool = False) -> DataFrame:
    """(node, twin) of the nodes of ``edges`` (x, y; no loops, no repeats): the least of the nodes that have the same edges in and out, each other's and their own counted in.

    Twins are linked with each other, and with others all alike. Sets of ends are compared by their number, least end and two hashes of 64 bits each way; where ``edges`` are ``whole``
    (both directions), one way says it all.
    """
    ends = edges.select(F.col("x").alias("node"), F.col("y").alias("end"), F.lit(True).alias("out"))
    ways = {"out": F.col("out")}
    if not whole:
        ends = ends.unionByName(edges.select(F.col("y").alias("node"), F.col("x").alias("end"), F.lit(False).alias("out")))
        ways["in"] = ~F.col("out")
    hashes = lambda c: [F.xxhash64(c), F.xxhash64(F.lit("twin"), c)]
    found = ends.groupBy("node").agg(
        F.min("end").alias("least"), *(F.count_if(when).alias(f"n_{way}") for way, when in ways.items()),
        *(F.bit_xor(F.when(when, h)).alias(f"h{k}_{way}") for way, when in ways.items() for k, h in enumerate(hashes(F.col("end")))),
    )
    own = [F.coalesce(f"h{k}_{way}", F.lit(0)).bitwiseXOR(h).alias(f"h{k}_{way}") for way in ways for k, h in enumerate(hashes(F.col("node")))]
    signed = found.select("node", F.least("node", "least").alias("least"), *(f"n_{way}" for way in ways), *own)
    return signed.select("node", F.min("node").over(Window.partitionBy(*signed.columns[1:])).alias("twin"))


def closed(edges: DataFrame, labels: DataFrame) -> bool:
    """Whether every two nodes of a class are linked, so that no closure adds to ``edges`` (x, y; both directions, no loops, no repeats). ``labels``: their ``classes``."""
    sizes = labels.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    return edges.count() == (sizes.agg(F.sum(F.col("n") * (F.col("n") - 1))).first()[0] or 0)


def transitive(edges: DataFrame, rounds: int = 3, whole: bool = False) -> DataFrame:
    """What a bounded closure adds to ``edges``: in each round x -> z for x -> y -> z, all different, so paths double; new pairs only. ``whole``: ``edges`` are tables that have both directions, no loops and no repeats.

    Twins have the same paths to others, so the least of them goes through the rounds for all, and what it finds is found for each. A class that is closed already is one node.
    """
    edges = edges.select("x", "y") if whole else written(edges.where("x != y").select("x", "y").distinct(), "edges")
    named = written(twins(edges, whole), "twins")
    known = written(between_twins(edges, named), "closure")
    start = known
    for _ in range(rounds):
        step = known.join(known.select(F.col("x").alias("y"), F.col("y").alias("z")), "y").where("x != z").select("x", F.col("z").alias("y")).distinct()
        new = written(step.join(known, ["x", "y"], "left_anti"), "closure")
        if new.isEmpty():
            break
        known = written(known.unionByName(new), "closure")
    found = known.join(start, ["x", "y"], "left_anti")
    for end in ("x", "y"):
        found = found.join(named.select(F.col("twin").alias(end), F.col("node").alias(f"{end}_node")), end).withColumn(end, F.col(f"{end}_node"))
    return found.select("x", "y")


def between_twins(edges: DataFrame, named: DataFrame) -> DataFrame:
    """The ``edges`` (x, y) between the least of the ``twins`` that ``named`` has."""
    least = named.where("node = twin")
    return edges.join(least.select(F.col("node").alias("x")), "x", "left_semi").join(least.select(F.col("node").alias("y")), "y", "left_semi").select("x", "y")


def classes(edges: DataFrame, max_rounds: int = 60, whole: bool = False) -> DataFrame:
    """(node, root) of the connected components, root the least node; unbounded, unlike ``transitive``. Each round takes over the least label around, then labels' labels.

    ``whole``: ``edges`` are tables that have both directions, no loops and no repeats. Then the least of ``twins`` goes through the rounds for all.
    """
    if whole:
        named = written(twins(edges, True), "twins")
        found = classes(between_twins(edges, named), max_rounds).select(F.col("node").alias("twin"), "root")
        return written(named.join(found, "twin", "left").select("node", F.coalesce("root", "twin").alias("root")), "labels")
    edges = written(both_ways(edges.select("x", "y").where("x != y")), "classes")
    labels = written(edges.groupBy(F.col("x").alias("node")).agg(F.least("node", F.min("y")).alias("root")), "labels")
    for _ in range(max_rounds):
        around = edges.join(labels.select(F.col("node").alias("y"), "root"), "y").groupBy(F.col("x").alias("node")).agg(F.min("root").alias("near"))
        nearer = labels.join(around, "node").select("node", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = nearer.select(F.col("node").alias("root"), F.col("root").alias("far"))
        after = written(nearer.join(jump, "root", "left").select("node", F.coalesce("far", "root").alias("root"), "was"), "labels")
        labels = after.select("node", "root")
        if after.where("root != was").isEmpty():
            return labels
    raise RuntimeError("classes did not settle")


def extended(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``classes`` once ``edges`` (x, y; both directions) come to those that ``labels`` are of: only classes that they link change."""
    for end in ("x", "y"):
        edges = edges.join(labels.select(F.col("node").alias(end), F.col("root").alias("of")), end, "left").withColumn(end, F.coalesce("of", end)).drop("of")
    more = classes(written(edges.where("x != y").select("x", "y").distinct(), "classes"), whole=True)
    moved = labels.join(more.select(F.col("node").alias("root"), F.col("root").alias("far")), "root", "left").select("node", F.coalesce("far", "root").alias("root"))
    return written(moved.unionByName(more.join(labels, "node", "left_anti").select("node", "root")), "labels")


def compared(i: Column, j: Column, n: Column, window: int = WINDOW) -> Column:
    """Whether positions i < j of n sorted rows are compared: all in the first and the last window, and half a window around each between."""
    half = window // 2
    inner_j = j.between(half + 1, n - half) & (j - i <= half)
    inner_i = i.between(half + 1, n - half) & (j - i <= half - 1)
    return (n <= window) | (j <= window - 1) | (i >= n - window) | inner_j | inner_i


def similar(a: Column, b: Column, degree: int) -> Column:
    """Whether two values agree to ``degree`` percent by edit distance over their mean length, in 32-bit floats; degree 19: same first letter."""
    if degree == FIRST_LETTER:
        return (F.length(a) > 0) & (F.substring(a, 1, 1) == F.substring(b, 1, 1))
    distance = F.levenshtein(F.lower(a), F.lower(b))
    mean = F.floor((F.length(a) + F.length(b)) / 2).cast("int")
    score = (F.lit(1).cast("float") - distance.cast("float") / mean.cast("float")).cast("float") * F.lit(100).cast("float")
    return (distance == 0) | ((mean > 0) & (distance < mean) & (score >= F.lit(float(degree)).cast("float")))


def fuzzy(values: DataFrame, degree: int, order: tuple[str, ...] = ("value", "x"), window: int = WINDOW) -> DataFrame:
    """Pairs of rows (x, value) that a sliding window over the sorted rows compares and finds similar; both directions.

    The band join is an equi-join on blocks of half a window: a row meets its own block and the two after it; the first and the last window, compared in full, fit into it.
    """
    rows = with_position(values, *order)
    n = F.lit(rows.count())
    half = window // 2
    block = F.floor(F.col("rn") / half)
    left = rows.select(F.col("x"), F.col("value").alias("a"), F.col("rn").alias("i"), F.explode(F.array(block, block + 1, block + 2)).alias("block"))
    right = rows.select(F.col("x").alias("y"), F.col("value").alias("b"), F.col("rn").alias("j"), block.alias("block"))
    pairs = left.join(right, "block").where("i < j").where(compared(F.col("i"), F.col("j"), n, window)).where(similar(F.col("a"), F.col("b"), degree))
    return both_ways(pairs.select("x", "y").where("x != y"))


def supplemented(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """``pairs`` both ways, and for every x also for each y that x is the same as."""
    pairs = both_ways(pairs)
    more = pairs.join(edges.where("x != y").select("x", F.col("y").alias("peer")), "x").select(F.col("peer").alias("x"), "y")
    return pairs.unionByName(more.where("x != y")).distinct()


def name_ladder(holders: DataFrame, forms: DataFrame, different: DataFrame | None = None) -> DataFrame:
    """Pairs of persons whose normal forms meet on a step of the ladder.

    ``holders`` (x, node) says whose name a node is, ``forms`` (node, level, value) are the nodes' forms. On each step x's node must have neither guard; y's either hasn't
    them too, or y is the least holder of the value on its level.
    """
    spark = forms.sparkSession
    steps = F.broadcast(spark.createDataFrame(LADDER, "x_level string, y_level string, guard string, guard_x string"))
    levels = forms.groupBy("node").agg(F.collect_set("level").alias("levels"))
    held = written(holders.select("x", "node").distinct().join(forms.select("node", "level", "value").distinct(), "node").join(levels, "node"), "held")
    free = ~F.array_contains("levels", F.col("guard")) & ~F.array_contains("levels", F.col("guard_x"))
    xs = held.join(steps, held["level"] == steps["x_level"]).where(free).select("x", "value", "y_level", "guard", "guard_x")
    ys = held.withColumnRenamed("x", "y").withColumnRenamed("level", "y_level")
    least = ys.groupBy("y_level", "value").agg(F.min("y").alias("least"))
    open_y = xs.join(ys, ["y_level", "value"]).where(free).select("x", "y")
    least_y = xs.join(least, ["y_level", "value"]).select("x", F.col("least").alias("y"))
    return guarded(open_y.unionByName(least_y), None, different)


def suspicious(pairs: DataFrame, *by: str, least: int = 128) -> DataFrame:
    """Pairs, resources, and whether there are at least ``least`` pairs and half the square of the resources: one row, or one for each value of ``by``."""
    return judged(pairs.groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), F.countDistinct("x").alias("resources")), least)


def judged(sizes: DataFrame, least: int = 128) -> DataFrame:
    """``suspicious`` of rows with pairs and resources."""
    return sizes.withColumn("suspicious", (F.col("pairs") >= least) & (F.col("pairs") >= F.col("resources") * F.col("resources") / 2))
