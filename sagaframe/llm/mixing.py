"""Mixing sources to target weights (operator 8), with DataFrame functions alone.

Targets: sources in order of their code points (null last) weigh 1, 2, 3, 1, 2, 3, ... and share all tokens in proportion; a
target stops at `cap` times its source's tokens and the excess is shared again by weight until none is above.

Entropy balancing: among all document rates whose weighted tokens meet every target, take those closest in relative entropy to taking
each token once. The dual is convex, with one multiplier for each group of each margin: a margin is a column and a target for each of its
values, `copies` uses the one margin `source`, and `balance` takes any number (a source and a language, say). A rate is the exponential
tilt exp(sum of its groups' multipliers). Documents are summed once to cells, one a distinct combination of groups; each Newton
iteration sums the cells' tilted tokens over each margin's groups in Spark (gradient and curvature of the dual in these multipliers) and
moves them by gradient over curvature. Iterations end when every group is within TOLERANCE of its target, however many that takes;
margins that contradict each other never get there and raise after STALLED looks without progress.

Rounding into copies: each document gets floor(rate) copies, and some get one more. Documents of one source and size are a
stratum; strata go from large to small and carry their rounding error along, so that a source ends within about one short
document of its target. Strata are cut into cells of bounded size by a hash of the id before documents are ranked within them, so
a source or a group of copies holding a third of all rows is never sorted in one task. Ranks are by hash of the id, then by the id:
reruns agree.

Defined results: null texts and texts without words have size 0 and are taken 0 words; a null source is a source of its own, and
so is an empty one; repeated ids are rows of their own (rows equal in id, source and size may swap copies among themselves); an
empty table gives no rows; further columns are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sagaframe.session import cut

WORD = r"[^\x20\x09-\x0D]+"
#: How near to its target, in parts of it, each group must come.
TOLERANCE = 1e-10
#: Looks in a row at which the worst group may have failed to get nearer by a tenth before the margins count as contradictory.
STALLED = 4
#: Newton iterations between two looks.
AT_ONCE = 8
CELL = 256
CHUNK = 256


def words_in(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id: Column, source: Column, text: Column) -> Column:
    """Names a row by its id, source and text; rows equal in all three share it."""
    return F.xxhash64(doc_id.cast("string"), source.cast("string"), text.cast("string"))


def balance(cells: DataFrame, margins: dict[str, DataFrame], tokens: str = "tokens") -> DataFrame:
    """The cells (a column for each margin, and their tokens) with a column rate.

    `margins`: for each column a frame (that column, target) with one row a value; targets of 0 take nothing. Cells are as many as
    there are distinct combinations of groups, and are kept in the shared folder between iterations.
    """
    state = cells
    for name, wanted in margins.items():
        side = wanted.select(F.col(name).alias("__group"), F.col("target").cast("double").alias(f"__t_{name}"))
        state = state.join(side, F.col(name).eqNullSafe(F.col("__group")), "left").drop("__group").withColumn(f"__l_{name}", F.lit(0.0))
    none = F.lit(False)
    for name in margins:
        none = none | ~(F.coalesce(F.col(f"__t_{name}"), F.lit(0.0)) > 0)
    state = state.withColumn("__on", ~none & (F.col(tokens) > 0))
    tilt = F.exp(sum((F.col(f"__l_{name}") for name in margins), F.lit(0.0)))
    held = F.when(F.col("__on"), F.col(tokens) * tilt).otherwise(0.0)
    over = lambda name: F.sum(held).over(Window.partitionBy(name))
    gap = lambda name: F.when(F.col("__on"), F.abs(over(name) / F.col(f"__t_{name}") - 1))
    best, since = float("inf"), 0
    while True:
        for _ in range(AT_ONCE):
            for name in margins:  # gradient over curvature; for one group both are sums of tilted tokens
                state = state.withColumn(f"__l_{name}", F.when(F.col("__on"), F.col(f"__l_{name}") - (over(name) - F.col(f"__t_{name}")) / over(name)).otherwise(0.0))
        state = cut(state)
        worst = state.select(F.greatest(*[gap(n) for n in margins], F.lit(0.0)).alias("w")).agg(F.max("w").alias("w")).first().w or 0.0
        if worst <= TOLERANCE:
            rate = F.when(F.col("__on"), tilt).otherwise(0.0)
            return state.withColumn("rate", rate).select(*cells.columns, "rate")
        best, since = (worst, 0) if worst < 0.9 * best else (best, since + 1)
        if since >= STALLED:
            raise ValueError(f"the targets contradict each other: after all iterations a group is {worst:.3g} of its target away")


def targets(sizes: DataFrame, cap: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """source, source_size, target, from one row per source with source_size. One row a source: it fits a task."""
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    weigh = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = sizes.withColumn("weight", weigh).withColumn("room", F.col("source_size") * F.lit(cap))
    # A source is full if the level t (tokens per weight) exceeds room / weight. Sources in the order of room / weight fill up
    # one after another; t for k full sources is (all - room of those k) / (weight of the others).
    by_level = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    filled = (
        ranked.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("left", F.col("total") - F.coalesce(F.sum("room").over(before), F.lit(0.0)))
        .withColumn("others", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", F.col("left") / F.col("others"))
        .withColumn("full", F.col("room") <= F.col("level") * F.col("weight"))
    )
    level = F.min(F.when(~F.col("full"), F.struct(F.col("room") / F.col("weight"), F.col("level")))).over(everything)["level"]
    return filled.withColumn("at", level).select("source", "source_size", F.when(F.col("full"), F.col("room")).otherwise(F.col("at") * F.col("weight")).alias("target"))


def _carry(strata: Column) -> Column:
    """Extra copies of each stratum (size, n, part), largest size first; what is over or short goes to the next stratum."""
    def one(acc: Column, x: Column) -> Column:
        want = acc["over"] + x["n"] * x["part"] * x["size"]
        k = F.least(F.greatest(F.round(want / x["size"]).cast("long"), F.lit(0).cast("long")), x["n"])
        return F.struct((want - k * x["size"]).alias("over"), F.concat(acc["ks"], F.array(F.struct(x["size"].alias("size"), x["n"].alias("n"), k.alias("extra")))).alias("ks"))

    kind = "array<struct<size:bigint,n:bigint,extra:bigint>>"

    def chunk(acc: Column, xs: Column) -> Column:
        done = F.aggregate(xs, F.struct(acc["over"].alias("over"), F.array().cast(kind).alias("ks")), one)
        return F.struct(done["over"].alias("over"), F.concat(acc["out"], F.array(done["ks"])).alias("out"))

    chunks = F.transform(F.sequence(F.lit(1), F.size(strata), F.lit(CHUNK)), lambda i: F.slice(strata, i, CHUNK))
    return F.flatten(F.aggregate(chunks, F.struct(F.lit(0.0).alias("over"), F.array().cast(f"array<{kind}>").alias("out")), chunk)["out"])


def copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", cap: float = 3.0, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """id, source, size, key, source_size, target, rate, copies: one row per document; `key` is its `row_key`. Sizes are computed once and kept in the shared folder."""
    sized = cut(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), words_in(F.col(text_col)).alias("size"), row_key(F.col(id_col), F.col(source_col), F.col(text_col)).alias("key")))
    wanted = cut(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cap, weights))
    rated = balance(wanted.select("source", F.col("source_size").alias("tokens")), {"source": wanted.select("source", "target")}).select(F.col("source").alias("__s"), "rate")
    wanted = wanted.join(rated, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    rate = F.col("rate")
    # The rate of a source at its cap is the cap itself, not a rounding error below it.
    rate = F.when(F.abs(rate - F.round(rate)) < 1e-9, F.round(rate)).otherwise(rate)
    rates = wanted.withColumn("rate", F.least(rate, F.lit(cap))).withColumn("part", F.col("rate") - F.floor("rate"))
    same = F.col("s.source").eqNullSafe(F.col("r.source"))
    strata = sized.filter("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))
    listed = strata.alias("s").join(rates.alias("r"), same).groupBy("s.source").agg(F.sort_array(F.collect_list(F.struct("size", "n", "part")), asc=False).alias("xs"))
    extra = listed.select("source", F.explode(_carry(F.col("xs"))).alias("x")).select("source", "x.*")
    some, empty = sized.filter("size > 0"), sized.filter("size = 0")
    # Cells: a stratum's ids by hash, so many that one has about CELL rows; the extra copies are dealt over the cells by their running counts.
    cell_of = F.pmod(F.xxhash64("id", F.lit(1)), F.ceil(F.col("e.n") / CELL))
    keyed = some.alias("d").join(extra.alias("e"), F.col("d.source").eqNullSafe(F.col("e.source")) & (F.col("d.size") == F.col("e.size"))).select("d.*", "e.n", "e.extra", cell_of.alias("cell"))
    order = Window.partitionBy("source", "size").orderBy("cell")
    counts = keyed.groupBy("source", "size", "cell").agg(F.count(F.lit(1)).alias("m"), F.first("n").alias("n"), F.first("extra").alias("extra"))
    after = F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, 0))
    share = lambda x: F.floor(F.col("extra") * x / F.col("n"))
    quota = counts.select("source", "size", "cell", (share(after) - share(after - F.col("m"))).alias("quota"))
    rank = Window.partitionBy("source", "size", "cell").orderBy(F.xxhash64("id", F.lit(2)), F.col("id"))
    ranked = keyed.drop("n", "extra").withColumn("rank", F.row_number().over(rank))
    q = ranked.alias("k").join(quota.alias("q"), F.col("k.source").eqNullSafe(F.col("q.source")) & (F.col("k.size") == F.col("q.size")) & (F.col("k.cell") == F.col("q.cell"))).select("k.id", "k.source", "k.size", "k.key", (F.col("rank") <= F.col("quota")).cast("long").alias("more"))
    every = q.unionByName(empty.select("id", "source", "size", "key", F.lit(None).cast("long").alias("more")))
    return every.alias("s").join(rates.alias("r"), same).select("s.id", "s.source", "s.size", "s.key", "r.source_size", "r.target", "r.rate", F.coalesce(F.floor("rate") + F.col("more"), F.lit(0)).cast("long").alias("copies"))
