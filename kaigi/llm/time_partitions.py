r"""Adaptive time partitions (11): files of at most L rows, in calendar runs that adapt to where the rows are.

From the bottom up: all hours are counted; a complete set of siblings collapses into its parent where the parent holds no more
than L rows, hours into days, days into months, months into years.  What survives are the complete sets (empty siblings too)
under each parent above L, and the years from the first moment to the last.  Within each set next-fit joins siblings in time
order: one within L joins the run of the sibling before it if that stays within L, else it starts a run.  A run with rows is a
leaf, and so are an hour above L and the rows without a moment (`null`).  Leaves above L are cut into parts.

Fewer than rows / L nodes of a level are above L, so where L is a fixed share of the rows the surviving nodes, leaves and files are
bounded whatever the input's size; only they are broadcast or reach the driver.  Rows are sent to leaves by the number of
the smallest surviving node around their hour.  Leaves above L are put in order over ranges of all their rows, so no task holds
one of them; each file is then sorted and written as a stream by one task, as a file has to be.

A layout that is laid over an older one leaves those files as they are whose leaf, part and rows recur (number and four sums of
two row hashes agree), writes the others beside them and then deletes what is left of the old ones.  A reader that lists the
folder while it is rewritten can see rows of both.

Within a leaf rows follow by moment and `order`, nulls first, then by a hash of the whole row, so that only equal rows can
change places.  Null moments have their own leaf.  Repeated rows stay.  Columns of any name are kept as they are (they travel as one
struct).  Without rows there are no files.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .exchange import settled, sized

#: Numbers of nodes: year * HERE["month"] and so on, each finer part added; an hour counts from 1, so that no number stands for two.
DAY, MONTH, YEAR = 100, 10_000, 1_000_000
NO_MOMENT = 0
_PRINTS = ("p0", "p1", "p2", "p3")
FILES = "leaf string, part long, n_rows long, n_new long, p0 long, p1 long, p2 long, p3 long, path string, rewritten boolean"


def hour_node(moment: Column) -> Column:
    """The number of a moment's hour; null stays null."""
    return F.year(moment).cast("long") * YEAR + F.month(moment) * MONTH + F.dayofmonth(moment) * DAY + F.hour(moment) + 1


def around(node: Column, unit: int) -> Column:
    """The number of the day, month or year around a node."""
    return node - node % unit


def _children(parent: Column, unit: int) -> Column:
    """All children of a node, in time order."""
    if unit == DAY:
        return F.sequence(parent + 1, parent + 24)
    if unit == MONTH:
        last = F.dayofmonth(F.last_day(F.make_date(F.expr(f"int(parent div {YEAR})"), F.expr(f"int(parent div {MONTH} % 100)"), F.lit(1))))
        return F.sequence(parent + DAY, parent + DAY * last, F.lit(DAY))
    return F.sequence(parent + MONTH, parent + 12 * MONTH, F.lit(MONTH))


def _next_fit(siblings: DataFrame, limit: int, finest: bool) -> DataFrame:
    """parent, first, last, n of the runs with rows of each parent's siblings (parent, node, n); one set is a few dozen rows, or
    the years."""
    empty = F.array().cast("array<struct<first:bigint,last:bigint,n:bigint,open:boolean,leaf:boolean>>")
    run = lambda first, last, n, is_open, leaf: F.array(F.struct(first.alias("first"), last.alias("last"), n.alias("n"), is_open.alias("open"), leaf.alias("leaf")))

    def step(runs, x):
        top, fits = F.try_element_at(runs, F.lit(-1)), x["n"] <= limit
        joins = fits & F.coalesce(top["open"] & (top["n"] + x["n"] <= limit), F.lit(False))
        longer = F.concat(F.slice(runs, F.lit(1), F.size(runs) - 1), run(top["first"], x["node"], top["n"] + x["n"], F.lit(True), F.lit(True)))
        return F.when(joins, longer).otherwise(F.concat(runs, run(x["node"], x["node"], x["n"], fits, fits | F.lit(finest))))

    in_order = F.array_sort(F.collect_list(F.struct("node", "n")))
    runs = siblings.groupBy("parent").agg(in_order.alias("s")).select("parent", F.explode(F.aggregate("s", empty, step)).alias("run"))
    return runs.select("parent", "run.first", "run.last", "run.n").where("run.leaf and run.n > 0")


def _name(unit: int) -> Column:
    """The name of a run of siblings that lie a step of `unit` apart."""
    part = lambda node, at, width: F.lpad((F.floor(node / at) % 10**width).cast("string"), width, "0")
    label = lambda node: F.lpad((node % DAY - 1).cast("string"), 2, "0") if unit == 1 else part(node, unit, 4 if unit == YEAR else 2)
    above = [part(F.col("first"), at, width) for at, width in ((YEAR, 4), (MONTH, 2), (DAY, 2)) if at > unit]
    return F.concat_ws("/", *above, F.concat(label(F.col("first")), F.lit("-"), label(F.col("last"))))


class Layout:
    """Leaves over hours (node of the hour, null for none; n rows): `leaves` (leaf: a number that ascends in time, name, n) and
    `place`, the leaf of an hour."""

    def __init__(self, hours: DataFrame, limit: int):
        self.limit = limit
        nodes = hours.where("hour is not null and n > 0").select(F.col("hour").alias("node"), "n")
        runs, split = [], []
        for below, unit in ((1, DAY), (DAY, MONTH), (MONTH, YEAR)):
            parents = nodes.groupBy(around(F.col("node"), unit).alias("node")).agg(F.sum("n").alias("n"))
            large = parents.where(F.col("n") > limit).select(F.col("node").alias("parent"))
            kept = large.select("parent", F.explode(_children(F.col("parent"), unit)).alias("node"))
            runs.append(self._runs(kept, nodes, below))
            split.append(large)
            nodes = settled(parents)
        ends = nodes.agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a is not null")
        runs.append(self._runs(ends.select(F.lit(0).cast("long").alias("parent"), F.explode(F.sequence("a", "b", F.lit(YEAR))).alias("node")), nodes, YEAR))
        without = hours.where("hour is null and n > 0").groupBy().agg(F.sum("n").alias("n")).where("n > 0")
        runs.append(without.select(*(F.lit(NO_MOMENT).cast("long").alias(c) for c in ("parent", "first", "last")), "n", F.lit("null").alias("name"), F.lit(1).alias("step")))
        made = runs[0]
        for more in runs[1:]:
            made = made.unionByName(more)
        made = settled(made)
        self.leaves = made.select(F.col("first").alias("leaf"), "name", "n")
        self._members = made.select(F.explode(F.sequence("first", "last", "step")).alias("node"), F.col("first").alias("leaf"), F.col("n").alias("leaf_n"))
        self._split = [r.parent for r in split[0].union(split[1]).union(split[2]).collect()]

    def _runs(self, kept: DataFrame, nodes: DataFrame, unit: int) -> DataFrame:
        siblings = kept.join(nodes, "node", "left").select("parent", "node", F.coalesce("n", F.lit(0)).alias("n"))
        return _next_fit(siblings, self.limit, unit == 1).withColumn("name", _name(unit)).withColumn("step", F.lit(unit))

    def place(self, rows: DataFrame, hour: str = "hour") -> DataFrame:
        """rows with leaf and leaf_n, the rows of that leaf."""
        node = F.col(hour)
        for unit in (DAY, MONTH, YEAR):
            node = F.when(around(F.col(hour), unit).isin(self._split), node).otherwise(around(F.col(hour), unit)) if self._split else around(F.col(hour), unit)
        return rows.withColumn("node", F.coalesce(node, F.lit(NO_MOMENT))).join(F.broadcast(self._members), "node").drop("node")


def _in_parts(placed: DataFrame, limit: int) -> DataFrame:
    """placed with part (from 1).  Leaves above limit are put in order over ranges, and a row's place is its place in its range
    and the rows of its leaf in the ranges before."""
    small = placed.where(F.col("leaf_n") <= limit).withColumn("part", F.lit(1).cast("long"))
    order = ("leaf", "moment", "by", "tie")
    large = settled(placed.where(F.col("leaf_n") > limit).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()))
    large = large.withColumn("range", F.shiftright("at", 33))
    ranges = large.groupBy("leaf", "range").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("held"))
    before = Window.partitionBy("leaf").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = settled(ranges.withColumn("before", F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("low")).select("leaf", "range", "before"))
    ranked = large.join(sized(ranges), ["leaf", "range"]).withColumn("part", F.floor((F.col("at") + F.col("before")) / limit) + 1)
    return small.unionByName(ranked.select(small.columns))


def _store(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def data_files(spark: SparkSession, folder: str) -> list[str]:
    """The Parquet files of a layout's folder, as full addresses; there are no more than it has leaves and parts."""
    store, path = _store(spark, folder)
    return [re.sub("^file:/+", "file:///", s.getPath().toString()) for s in store.listStatus(path) if s.getPath().getName().endswith(".parquet")]


def lay_out(rows: DataFrame, moment: Column, order: tuple[str, ...], limit: int, folder: str, before: DataFrame | None = None, known: Column | None = None) -> DataFrame:
    """Writes rows to a folder in leaves and parts of at most `limit` rows; FILES of the folder as it is then.

    before: what lay_out returned for the folder's present files, if it has any.  known: whether a row lies in one of those.  n_new
    counts the rows that don't."""
    spark = rows.sparkSession
    given = rows.select(
        moment.cast("timestamp_ntz").alias("moment"), F.struct(*(F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(order))).alias("by"), (F.lit(False) if known is None else F.coalesce(known, F.lit(False))).alias("known"),
        F.struct(*(F.col(f"`{c}`") for c in rows.columns)).alias("row"),
    ).withColumn("hour", hour_node(F.col("moment")))
    layout = Layout(settled(given.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))), limit)
    second = F.xxhash64(F.lit(1), "row")
    placed = _in_parts(layout.place(given.withColumn("tie", F.xxhash64("row"))).drop("hour"), limit)
    low, high = (lambda h: F.sum(h.bitwiseAND(0xFFFFFF))), (lambda h: F.sum(F.shiftrightunsigned(h, 24).bitwiseAND(0xFFFFFF)))
    files = placed.groupBy("leaf", "part").agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(~F.col("known")).alias("n_new"), low(F.col("tie")).alias("p0"), high(F.col("tie")).alias("p1"), low(second).alias("p2"), high(second).alias("p3"))
    files = settled(files.join(F.broadcast(layout.leaves.select("leaf", "name")), "leaf"))
    if before is not None:
        old = before.select(F.col("leaf").alias("name"), "part", "n_rows", *_PRINTS, F.col("path").alias("old"))
        files = files.join(F.broadcast(old), ["name", "part", "n_rows", *_PRINTS], "left")
    else:
        files = files.withColumn("old", F.lit(None).cast("string"))
    number = F.row_number().over(Window.orderBy(F.col("old").isNotNull(), "leaf", "part")) - 1
    files = settled(files.withColumn("number", number))
    new = files.where("old is null")
    n_new, present = new.count(), set(data_files(spark, folder))
    if n_new:
        chosen = placed.join(F.broadcast(new.select("leaf", "part", "number")), ["leaf", "part"])
        dealt = chosen.repartitionById(n_new, F.col("number")).sortWithinPartitions("moment", "by", "tie")
        dealt.select("row.*").write.mode("append").option("maxRecordsPerFile", 0).parquet(folder)
    # A task's file bears the task's number, which is the file's.
    paths = [(int(p.rpartition("/")[2].split("-")[1]), p) for p in data_files(spark, folder) if p not in present]
    if len(paths) != n_new:
        raise RuntimeError(f"{n_new} files were asked for, {len(paths)} lie in {folder}")
    told = spark.createDataFrame(paths, "number int, new string")
    files = files.join(F.broadcast(told), "number", "left").select(F.col("name").alias("leaf"), "part", "n_rows", "n_new", *_PRINTS, F.coalesce("old", "new").alias("path"), F.col("old").isNull().alias("rewritten"))
    files = settled(files)
    store, _ = _store(spark, folder)
    for path in present - {r.path for r in files.where("not rewritten").select("path").collect()}:
        store.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path), False)
    return files


def _digests(batches):
    number, seen, digest = None, 0, hashlib.sha256()
    for batch in batches:
        ids = batch.column("id").cast(pa.string()).fill_null("null")
        if len(ids):
            number = batch.column("number")[0].as_py()
            digest.update(((b"," if seen else b"") + ",".join(ids.to_pylist()).encode()))
            seen += len(ids)
    if number is not None:
        yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([digest.hexdigest()]), pa.array([seen])], ["number", "ids_sha256", "n_read"])


def read_back(files: DataFrame, folder: str, rows: DataFrame, key: str) -> DataFrame:
    """files (of lay_out) with columns and ids_sha256, the digest of the decimal keys in the order of the file's rows, all as read
    from the files: each file's keys are streamed through one task."""
    spark = rows.sparkSession
    known = settled(files.withColumn("number", F.row_number().over(Window.orderBy("path")) - 1).withColumn("file", F.element_at(F.split("path", "/"), -1)))
    n = known.count()
    found = spark.read.schema(rows.schema).parquet(folder).select(F.col(f"`{key}`").alias("id"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("at"))
    found = found.join(F.broadcast(known.select("file", "number")), "file").select("number", "at", "id")
    told = found.repartitionById(max(n, 1), F.col("number")).sortWithinPartitions("at").mapInArrow(_digests, "number int, ids_sha256 string, n_read long")
    told = settled(known.withColumn("columns", F.lit(",".join(rows.columns))).join(F.broadcast(told), "number", "left"))
    if wrong := told.where("n_read is null or n_read <> n_rows").select("path").collect():
        raise RuntimeError(f"{len(wrong)} files don't hold the rows that were sent there, {wrong[0].path} among them")
    return told.drop("number", "file", "n_read")
