"""Prefix trie of conversations that share heads, by composable fingerprints.

Every conversation is rebuilt from a head (the first turns of a base conversation) and its own
turns after as many. No rebuilt text is made: a sequence of turns is an element (n, v) of a monoid,
v the sum of the turns' values times powers of a base modulo a prime, and (n, v) (m, w) = (n + m,
v + base^n w). The elements of head and own suffix are taken from running products of the stored
conversations and multiplied symbolically, modulo four primes at once (124 bits). Rows of equal
depth and product are a prefix group, a node of the trie.

Groups are verified: all members must end in the same stored turn, which with equal products means
equal products one turn earlier, and so on to the root; and a turn's reference must name one role
and text only, which a job over all turns checks. If two sequences share a product, all is done
anew with another base, so results do not depend on luck.

Running products along a conversation of any length are a scan over range slices: products within
a slice, the products of earlier slices combined before them. Sums over subtrees need no walk: a
node is counted at the conversation it is named after, and a node's subtree is made of the nodes
named after its members, less those above it. Digests of members are sequential by definition, so
the members of a node stream, sorted, through one task without being gathered.

Edge cases: null role or text is empty; turns are ordered with null first, equal turn numbers by
the SHA-256 of the two SHA-256 digests of role and text; repeated rows are turns of their own; rows
without a conversation number belong to no conversation and take no part; a conversation whose
base is absent has no head; an empty table has no node. Very long texts are only digested. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.llm import common

# The four largest primes below 2 to the 31st.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
PARTS = range(len(PRIMES))
POWERS = 40  # bits of a position
PRODUCT, REFERENCE = ["fa", "fb"], ["ta", "tb"]
KEY = ["depth", *PRODUCT]


class Base:
    """Powers of one base per prime, as column expressions."""

    def __init__(self, seed: int):
        digest = hashlib.sha256(f"trie base {seed}".encode()).digest()
        draws = (int.from_bytes(digest[8 * k : 8 * k + 8], "big") for k in PARTS)
        self.bases = [1000 + d % (p - 2000) for d, p in zip(draws, PRIMES, strict=True)]

    def power(self, k: int, exponent: Column) -> Column:
        """bases[k] ** exponent modulo the prime, by squares."""
        p, squares = PRIMES[k], [self.bases[k]]
        while len(squares) < POWERS:
            squares.append(squares[-1] ** 2 % p)
        table = F.array(*[F.lit(s) for s in squares])
        top = F.floor(F.log2(F.greatest(exponent, F.lit(1)))).cast("int")
        return F.aggregate(
            F.sequence(F.lit(0), top),
            F.lit(1).cast("long"),
            lambda done, bit: F.when(
                F.call_function("getbit", exponent, bit) == 1, done * F.get(table, bit) % p
            ).otherwise(done),
        )

    def shrunk(self, k: int, value: Column, turns: Column, most: int) -> Column:
        """value times bases[k] ** -turns, for at most `most` turns."""
        inverse = pow(self.bases[k], -1, PRIMES[k])
        table = [F.lit(pow(inverse, i, PRIMES[k])) for i in range(most + 1)]
        return value * F.get(F.array(*table), turns.cast("int")) % PRIMES[k]


def _pack(parts: list[Column]) -> tuple[Column, Column]:
    return tuple(F.shiftleft(parts[i], 31) + parts[i + 1] for i in (0, 2))


def _unpack(a: str, b: str) -> list[Column]:
    low = F.lit((1 << 31) - 1)
    return [x for c in (a, b) for x in (F.shiftright(F.col(c), 31), F.col(c).bitwiseAND(low))]


def _digest(role: Column, text: Column) -> Column:
    return F.sha2(F.concat(F.sha2(role, 256), F.sha2(text, 256)), 256)


def _values(digest: Column) -> list[Column]:
    parts = (F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in PARTS)
    return [part % p for part, p in zip(parts, PRIMES, strict=True)]


def _plain(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.filter(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def _sliced(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """The rows, written in range slices of the order, `slice` numbering them in order.

    The last key is the place in the input, so that rows equal in all others are dealt over
    slices too.
    """
    placed = rows.withColumn("at", F.monotonically_increasing_id())
    ranged = placed.repartitionByRange(*order, F.col("at"))
    return common.written(ranged.withColumn("slice", F.spark_partition_id()), name)


def _within(key: str, *order: Column):
    """Rows up to and with this one, of its key and slice."""
    window = Window.partitionBy("slice", key).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, 0)


def _before(totals: DataFrame, key: str, sums: dict[str, Column]) -> DataFrame:
    """What the earlier slices of a key add up to, for slices that continue a key.

    In sorted slices only the first key of a slice continues one, so there is at most one row per
    slice, of which there are no more than shuffle partitions: small enough to broadcast. `sums`
    are taken in turn, later ones may use earlier ones; each is exclusive.
    """
    window = Window.partitionBy(key).orderBy("slice")
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    found = totals.withColumn("nth", F.row_number().over(window))
    for name, amount in sums.items():
        found = found.withColumn(name, F.coalesce(F.sum(amount).over(earlier), F.lit(0)))
    return F.broadcast(found.filter("nth > 1").select(key, "slice", *sums))


def _running(plain: DataFrame, base: Base) -> DataFrame:
    """(conv, pos from 0, ta, tb, bytes, q0..q3): each turn and the product up to and with it."""
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest")]
    light = plain.select(
        "conv", "turn", _digest(F.col("role"), F.col("text")).alias("digest"),
        F.octet_length("text").cast("long").alias("bytes"),
    )
    sliced = _sliced(light, order, "trie-turns")
    window = _within("conv", *order[1:], F.col("at"))

    def local(rows: DataFrame) -> DataFrame:
        packed = dict(zip(REFERENCE, _pack(_values(F.col("digest"))), strict=True))
        placed = rows.withColumns({"local": F.count(F.lit(1)).over(window) - 1, **packed})
        terms = {
            f"x{k}": v * base.power(k, F.col("local")) % PRIMES[k]
            for k, v in enumerate(_unpack(*REFERENCE))
        }
        sums = {f"v{k}": F.sum(f"x{k}").over(window) % PRIMES[k] for k in PARTS}
        return placed.withColumns(terms).withColumns(sums)

    ends = local(sliced.join(_continued(sliced, "conv"), ["conv", "slice"], "left_semi"))
    ends = ends.groupBy("conv", "slice").agg(
        F.max("local").alias("last"),
        *(F.max_by(f"v{k}", "local").alias(f"v{k}") for k in PARTS),
    )
    found = _before(
        ends, "conv",
        {
            "n": F.col("last") + 1,
            **{f"w{k}": F.col(f"v{k}") * base.power(k, F.col("n")) % PRIMES[k] for k in PARTS},
        },
    )
    joined = local(sliced).join(found, ["conv", "slice"], "left")
    n = F.coalesce("n", F.lit(0))
    products = [
        (F.coalesce(f"w{k}", F.lit(0)) + F.col(f"v{k}") * base.power(k, n) % PRIMES[k]) % PRIMES[k]
        for k in PARTS
    ]
    return joined.select(
        "conv", (F.col("local") + n).alias("pos"), *REFERENCE, "bytes",
        *(q.alias(f"q{k}") for k, q in enumerate(products)),
    )


def _continued(sliced: DataFrame, key: str) -> DataFrame:
    """(key, slice) of the keys that lie in several slices: at most two per slice (its first and
    its last), so small enough to broadcast."""
    held = sliced.select(key, "slice").distinct()
    many = held.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(key)
    return F.broadcast(held.join(many, key, "left_semi"))


def _rebuilt(running: DataFrame, base: Column, head: Column, longest: int, powers: Base) -> DataFrame:
    """(conv, depth, fa, fb, ta, tb, bytes, last): every prefix of every rebuilt conversation,
    from the empty one; `last` marks the whole conversation."""
    products = [f"q{k}" for k in PARTS]
    item = F.struct("pos", *REFERENCE, "bytes", *products)
    convs = running.groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"),
        # `longest` turns at most, whatever the length of the conversation.
        F.array_sort(F.collect_list(F.when(F.col("pos") < longest, item))).alias("first"),
    )
    plan = convs.withColumns({"base": base, "h": head.cast("int")})
    heads = convs.select(F.col("conv").alias("base"), F.col("first").alias("of_base"))
    none = F.array().cast(convs.schema["first"].dataType)
    plan = plan.join(heads, "base", "left").withColumn(
        "head", F.coalesce(F.slice("of_base", F.lit(1), F.col("h")), none)
    )
    m = F.size("head")

    def product(turns: str, n: Column, k: int) -> Column:
        """Product of the first n of some turns, zero of none."""
        last = F.get(F.col(turns), (n - 1).cast("int"))
        return F.coalesce(F.when(n > 0, last[f"q{k}"]), F.lit(0).cast("long"))

    plan = plan.select(
        "conv", "h", "n", "head", m.alias("m"),
        (m + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total"),
        *(product("head", m, k).alias(f"head{k}") for k in PARTS),
        *(product("first", F.least("h", "n"), k).alias(f"skip{k}") for k in PARTS),
    )
    plan = common.written(plan, "trie-plan")
    zero = F.lit(0).cast("long")
    roots = plan.select(
        "conv", zero.alias("depth"), *(zero.alias(c) for c in (*PRODUCT, *REFERENCE, "bytes")),
        (F.col("total") == 0).alias("last"),
    )
    headed = plan.select("conv", "total", F.explode("head").alias("t")).select(
        "conv", "total", (F.col("t.pos") + 1).alias("depth"), "t.*"
    )
    own = running.join(plan.drop("head", "n"), "conv").filter(F.col("pos") >= F.col("h"))
    joined = [
        (
            F.col(f"head{k}")
            + powers.shrunk(
                k, F.pmod(F.col(f"q{k}") - F.col(f"skip{k}"), F.lit(PRIMES[k])),
                F.col("h") - F.col("m"), longest,
            )
        ) % PRIMES[k]
        for k in PARTS
    ]
    own = own.withColumn("depth", F.col("m") + F.col("pos") - F.col("h") + 1).withColumns(
        dict(zip(products, joined, strict=True))
    )
    packed = [c.alias(n) for c, n in zip(_pack([F.col(q) for q in products]), PRODUCT, strict=True)]
    parts = [
        df.select(
            "conv", F.col("depth").cast("long").alias("depth"), *packed, *REFERENCE, "bytes",
            (F.col("depth") == F.col("total")).alias("last"),
        )
        for df in (headed, own)
    ]
    return common.written(roots.unionByName(parts[0]).unionByName(parts[1]), "trie-rows")


def _groups(rows: DataFrame, powers: Base) -> DataFrame:
    """A row per prefix group, with the product `pa`, `pb` of its parent."""
    ends = [f(c).alias(f"{f.__name__}_{c}") for c in REFERENCE for f in (F.min, F.max)]
    groups = rows.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("bytes").alias("bytes"),
        *ends,
    )
    # In the parent's product the last turn is missing.
    shorter = [
        F.pmod(f - t * powers.power(k, F.col("depth") - 1) % PRIMES[k], F.lit(PRIMES[k]))
        for k, (f, t) in enumerate(
            zip(_unpack(*PRODUCT), _unpack("min_ta", "min_tb"), strict=True)
        )
    ]
    return groups.withColumns(
        {
            n: F.when(F.col("depth") > 0, c)
            for n, c in zip(("pa", "pb"), _pack(shorter), strict=True)
        }
    )


def verify_references(plain: DataFrame) -> None:
    """Every reference names one role and text: all turns are compared, by grouping."""
    packed = _pack(_values(_digest(F.col("role"), F.col("text"))))
    named = plain.select(
        *(c.alias(n) for c, n in zip(packed, REFERENCE, strict=True)), "role", "text"
    )
    contents = named.groupBy(*REFERENCE, "role", "text").agg(F.count(F.lit(1)).alias("n"))
    clash = contents.groupBy(*REFERENCE).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not clash.isEmpty():
        raise RuntimeError("two different turns share 124 bits of their SHA-256 digests")


def build(
    turns: DataFrame,
    base: Column,
    head: Column,
    longest: int,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(nodes, rows) of the trie; jobs run at once.

    `base` and `head` are expressions over the column `conv`: the conversation that the head is
    taken from, and how many of its turns, `longest` at most. A node is known by `conv_id`, its
    smallest member, and `depth`; `ta` and `tb` refer to its last turn, see `turn_texts`. `rows`
    has every member of every node.
    """
    plain = _plain(turns, conversation, turn, role, text)
    verify_references(plain)
    for seed in range(64):
        powers = Base(seed)
        rows = _rebuilt(_running(plain, powers), base, head, longest, powers)
        groups = common.written(_groups(rows, powers), "trie-groups")
        if groups.filter("min_ta <> max_ta OR min_tb <> max_tb").isEmpty():
            return _nodes(rows, groups), rows
    raise RuntimeError("no base keeps the sequences apart")


def _nodes(rows: DataFrame, groups: DataFrame) -> DataFrame:
    above = groups.select(
        (F.col("depth") + 1).alias("depth"), F.col("fa").alias("pa"), F.col("fb").alias("pb"),
        F.col("conv_id").alias("parent_conv_id"),
    )
    below = groups.filter("depth > 0").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("fa"), F.col("pb").alias("fb")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = (
        groups.join(below, KEY, "left")
        .join(above, ["depth", "pa", "pb"], "left")
        .select(
            *KEY, "conv_id", "parent_conv_id", "n_convs", "bytes",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            F.col("min_ta").alias("ta"), F.col("min_tb").alias("tb"),
            ((F.col("n_convs") - 1) * F.col("bytes")).alias("shared"),
        )
    )
    nodes = common.written(nodes, "trie-nodes")
    # What is named after each conversation: saved bytes and leaves.
    named = nodes.groupBy(F.col("conv_id").alias("conv")).agg(
        F.sum("shared").alias("shared"),
        F.count(F.when(F.col("n_children") == 0, 1)).alias("leaves"),
    )
    under = rows.join(named, "conv").groupBy(*KEY).agg(
        F.sum("shared").alias("under"), F.sum("leaves").alias("n_leaves")
    )
    passed = _above(nodes.filter("n_convs > 1"))
    return (
        nodes.drop("shared", "bytes")
        .join(under, KEY)
        .join(passed, KEY, "left")
        # Below a node of one member nothing is shared.
        .withColumn("saved_tokens", F.when(F.col("n_convs") > 1, F.col("under") - F.col("passed")))
        .fillna(0, ["saved_tokens"])
        .drop("under", "passed")
    )


def _above(nodes: DataFrame) -> DataFrame:
    """(key, passed): the saved bytes of the nodes above, named after the same conversation."""
    light = nodes.select(*KEY, "conv_id", "shared")
    sliced = _sliced(light, [F.col("conv_id"), F.col("depth")], "trie-named")
    window = _within("conv_id", F.col("depth"))
    ends = sliced.join(_continued(sliced, "conv_id"), ["conv_id", "slice"], "left_semi")
    ends = ends.groupBy("conv_id", "slice").agg(F.sum("shared").alias("total"))
    found = _before(ends, "conv_id", {"before": F.col("total")})
    local = sliced.withColumn("upto", F.sum("shared").over(window) - F.col("shared"))
    joined = local.join(found, ["conv_id", "slice"], "left")
    passed = F.col("upto") + F.coalesce("before", F.lit(0))
    return joined.select(*KEY, passed.alias("passed"))


def member_digests(rows: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the numbers of the conversations that end at a node."""
    ends = rows.filter("last").select(*KEY, "conv")
    ordered = ends.repartition(*KEY).sortWithinPartitions(*KEY, "conv")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def result(done):
            columns = list(zip(*done, strict=True)) if done else [()] * (len(KEY) + 1)
            types = [pa.int64()] * len(KEY) + [pa.string()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, [*KEY, "ends_sha256"])

        for batch in batches:
            done = []
            *keys, convs = (c.to_pylist() for c in batch.columns)
            for *key, conv in zip(*keys, convs, strict=True):
                if key == now:
                    state.update(b",%d" % conv)
                    continue
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = key, hashlib.sha256(b"%d" % conv)
            yield result(done)
        if now is not None:
            yield result([(*now, state.hexdigest())])

    common.importable(rows.sparkSession)
    schema = ", ".join(f"{c} long" for c in KEY) + ", ends_sha256 string"
    return ordered.mapInArrow(digest, schema)


def turn_texts(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(ta, tb, role, text): what the references of the nodes stand for, once each."""
    plain = _plain(turns, conversation, turn, role, text)
    packed = _pack(_values(_digest(F.col("role"), F.col("text"))))
    names = [c.alias(n) for c, n in zip(packed, REFERENCE, strict=True)]
    return plain.select(*names, "role", "text").distinct()
