"""Mixing sources to target weights by pivotal dependent rounding.

A document of a source that is wanted ``p`` times over gets floor(p) copies and, by its fractional part, perhaps one
more. Two documents with fractional copies are paired, and words move from one to the other, randomly in either
direction, until one of the two is integral; expected copies and the source's expected words stay as they are. Pairing
runs inside buckets of a few dozen documents; what is left of each bucket, one document, meets the others of its
branch on the next level of a tree, so a source ends with one document, which is rounded to the nearer side. Every step
is a built-in expression; randomness is a hash of seed and document, so that reruns agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from passgrid.llm.columns import fresh, quoted, without
from passgrid.session import stage

MIX_SHARE = 1.5
MOST_COPIES = 2.0
WEIGHTS = (5.0, 2.0, 1.0)
SEED = 20
BUCKET_ROWS = 32
FAN_BITS = 5
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(NOT_SPACE)), F.lit(0)).cast("bigint")


def _chance(*parts: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *parts), 11) / F.lit(float(1 << 53))


def source_targets(sizes: DataFrame, *, share: float = MIX_SHARE, most: float = MOST_COPIES) -> DataFrame:
    """``src, weight, source_size`` with ``target``: the share of all sizes, dealt by weight; where that is more than
    ``most`` times the source's size, the excess goes to the others by weight until none is above.

    Each turn settles at least one source, or ends; a turn is one aggregate over the sources.
    """
    now = stage(sizes.withColumn("target", F.lit(None).cast("double")), "targets")
    total = now.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * share
    limit = F.col("source_size") * F.lit(float(most))
    while True:
        settled, weight = now.agg(
            F.coalesce(F.sum("target"), F.lit(0.0)),
            F.coalesce(F.sum(F.when(F.col("target").isNull(), F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weight:
            return now
        part = F.col("weight") * F.lit((total - settled) / weight)
        over = F.col("target").isNull() & (part >= limit)
        if now.filter(over).isEmpty():
            return now.withColumn("target", F.coalesce("target", part))
        now = stage(now.withColumn("target", F.when(over, limit).otherwise(F.col("target"))), "targets")


def _pair(items: Column) -> Column:
    """Pairs a bucket's items in turn: the decided ones, and the one that is left (or null)."""

    def step(state: Column, item: Column) -> Column:
        held = state["held"]
        room_up = F.least((1 - held["part"]) * held["size"], item["part"] * item["size"])
        room_down = F.least(held["part"] * held["size"], (1 - item["part"]) * item["size"])
        up = _chance(held["key"], item["key"]) * (room_up + room_down) < room_down
        # Up: words move from the new item to the one held, else the other way; who meets its end first is decided.
        held_done = F.when(up, (1 - held["part"]) * held["size"] <= item["part"] * item["size"]).otherwise(
            held["part"] * held["size"] <= (1 - item["part"]) * item["size"]
        )
        move = F.when(up, room_up).otherwise(-room_down)
        rest = F.when(held_done, item["part"] - move / item["size"]).otherwise(held["part"] + move / held["size"])
        # Rounding may leave a hair beyond the ends.
        rest = F.least(F.greatest(rest, F.lit(0.0)), F.lit(1.0))
        stays = F.when(held_done, item["key"]).otherwise(held["key"])
        left = F.struct(
            stays.alias("key"),
            F.when(held_done, item["size"]).otherwise(held["size"]).alias("size"),
            rest.alias("part"),
        )
        goes = F.struct(
            F.when(held_done, held["key"]).otherwise(item["key"]).alias("key"),
            F.when(held_done, up).otherwise(~up).cast("int").alias("extra"),
        )
        return (
            F.when(held.isNull(), F.struct(state["done"].alias("done"), item.alias("held")))
            .otherwise(F.struct(F.concat(state["done"], F.array(goes)).alias("done"), left.alias("held")))
        )

    start = F.struct(
        F.array().cast("array<struct<key:bigint,extra:int>>").alias("done"),
        F.lit(None).cast("struct<key:bigint,size:bigint,part:double>").alias("held"),
    )
    return F.aggregate(items, start, step)


def pivotal_rounding(items: DataFrame) -> DataFrame:
    """``src_key, key, extra`` (0 or 1) for items ``src_key, key, size, part`` with unique keys, sizes above 0 and parts
    between 0 and 1.

    Of a source's items, the sum of ``size * extra`` differs from that of ``size * part`` by half an item's size at most.
    """
    depth = items.groupBy("src_key").agg(F.count("*").alias("n"))
    bits = F.greatest(F.ceil(F.log2(F.col("n") / BUCKET_ROWS)), F.lit(0)).cast("int")
    depth = stage(depth.select("src_key", bits.alias("bits")), "depth")
    most = depth.agg(F.coalesce(F.max("bits"), F.lit(0))).first()[0]
    now = items.join(depth, "src_key").select("src_key", "bits", "key", "size", "part")
    decided = None
    level = 0
    while True:
        # A level's bucket is made of fewer low bits than that of the level below.
        bucket = F.expr(f"xxhash64(key) & (shiftleft(1L, greatest(bits - {level * FAN_BITS}, 0)) - 1)")
        met = (
            now.groupBy("src_key", "bits", bucket.alias("bucket"))
            .agg(F.sort_array(F.collect_list(F.struct("key", "size", "part"))).alias("items"))
            .select("src_key", "bits", _pair(F.col("items")).alias("state"))
        )
        met = stage(met.select("src_key", "bits", "state.done", "state.held"), f"level{level}")
        done = met.select("src_key", F.explode("done").alias("x")).select("src_key", "x.key", "x.extra")
        decided = done if decided is None else decided.unionByName(done)
        now = met.filter("held is not null").select("src_key", "bits", "held.key", "held.size", "held.part")
        if level * FAN_BITS >= most:
            break
        level += 1
    last = now.select("src_key", "key", (F.col("part") >= 0.5).cast("int").alias("extra"))
    return decided.unionByName(last)


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = MIX_SHARE,
    most: float = MOST_COPIES,
) -> DataFrame:
    """The documents with ``size, source_size, target, copies, taken``; columns of those names are replaced.

    ``size`` is the number of words, ``target`` what the document's source should give in all, ``copies`` how often the
    mix repeats the document, ``taken = copies * size``. ``weights`` (``source, weight``) defaults to 5, 2, 1 in turn
    over the sources by code point, null last; that ranking takes one row a source through one task, as a list of
    sources with weights does anyway. Sources without a weight get none of the mix.

    Null, empty and blank texts have size 0 and rank like any other document of their source: each is rounded by
    itself. Of repeated rows with one id and text, all but a fraction of one are rounded at once. A null source is a
    source. An empty table gives no rows.
    """
    out = ["size", "source_size", "target", "copies", "taken"]
    size, src, key, nth = fresh(docs, "_size", "_src", "_key", "_nth")
    text = quoted(text_col).cast("string")
    sized = docs.withColumns({
        size: word_count(text),
        src: F.xxhash64(quoted(source_col).cast("string").isNull(), quoted(source_col).cast("string")),
        key: F.xxhash64(quoted(source_col).cast("string"), quoted(id_col).cast("string"), text),
    })
    narrow = stage(
        sized.select(
            quoted(src).alias("src_key"),
            quoted(source_col).cast("string").alias("src"),
            quoted(key).alias("key"),
            quoted(size).alias("size"),
        ),
        "sizes",
    )
    units = stage(
        narrow.groupBy("src_key", "key").agg(
            F.first("src").alias("src"), F.max("size").alias("size"), F.count("*").alias("m")
        ),
        "units",
    )
    sources = units.groupBy("src_key", "src").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"))
    if weights is None:
        turn = (F.row_number().over(Window.orderBy(F.col("src").isNull(), F.col("src"))) - 1) % len(WEIGHTS)
        weighed = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), turn.cast("int") + 1))
    else:
        asked = weights.select(F.col("source").cast("string").alias("w_src"), F.col("weight").cast("double"))
        weighed = sources.join(asked, F.col("src").eqNullSafe(F.col("w_src")), "left").drop("w_src")
        weighed = weighed.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    targets = stage(source_targets(weighed, share=share, most=most), "targets")

    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    units = units.join(targets.select("src_key", wanted.alias("p")), "src_key")
    units = units.withColumn("base", F.floor("p").cast("int"))
    many = (F.col("p") - F.col("base")) * F.col("m")
    # Like rows are paired among themselves first: whole extras at once, a fraction of one is left.
    units = units.withColumn("sure", F.floor(many).cast("bigint")).withColumn("part", many - F.col("sure"))
    units = stage(units, "units")
    rounded = pivotal_rounding(
        units.filter("part > 0 and size > 0").select("src_key", "key", "size", "part")
    )
    alone = units.filter("part > 0 and size = 0").select(
        "src_key", "key", (_chance(F.lit("alone"), F.col("key")) < F.col("part")).cast("int").alias("extra")
    )
    extra = rounded.unionByName(alone)
    plan = (
        units.join(extra, ["src_key", "key"], "left")
        .select("key", "src_key", "base", (F.col("sure") + F.coalesce("extra", F.lit(0))).alias("extras"))
        .join(targets.select("src_key", "source_size", "target"), "src_key")
    )
    names = dict(zip(["base", "extras", "source_size", "target", "key", "src_key"], fresh(
        sized, "_base", "_extras", "_source_size", "_target", "_p_key", "_p_src")))
    plan = stage(plan, "plan").select(*[F.col(a).alias(b) for a, b in names.items()])
    same = (quoted(key) == quoted(names["key"])) & (quoted(src) == quoted(names["src_key"]))
    joined = sized.join(plan, same).withColumn(
        nth, F.row_number().over(Window.partitionBy(src, key).orderBy(F.lit(0)))
    )
    copies = (quoted(names["base"]) + (quoted(nth) <= quoted(names["extras"])).cast("int")).cast("int")
    return joined.select(
        *without(docs, out),
        quoted(size).alias("size"),
        quoted(names["source_size"]).alias("source_size"),
        quoted(names["target"]).alias("target"),
        copies.alias("copies"),
        (copies * quoted(size)).cast("bigint").alias("taken"),
    )
