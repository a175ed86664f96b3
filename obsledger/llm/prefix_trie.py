"""Prefix trie of conversations by van Emde Boas recursion: cuts at half depth, named prefixes, totals grafted upward."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.session import written

FAMILY = 5  # conversations of one family take over turns of its first one
MOST_TAKEN = 9  # fewer turns than this are taken over
SEGMENT = 256  # turns of a conversation, a power of two, that one task holds at a time
TURNS_PER_BUCKET = 1024  # turn numbers that are ranked together
IDS_PER_CHUNK = 4096
BLOCK_NODES = 50_000  # distinct nodes a task gathers before it hands them on
NAME = 16  # bytes
ROOT = bytes(NAME)
NOTHING = hashlib.sha256(b"").hexdigest()
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
_TRIE = "kind string, name binary, parent binary, depth bigint, size bigint, above binary, n bigint, conv_id bigint, pos bigint"


def _low_bit(number: Column) -> Column:
    return number.bitwiseAND(-number)


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, pos, token, size): turns in order from 0, each as digest of role and text, with its text's bytes.

    Ranks are counted in buckets of turn numbers and shifted by the sizes of earlier buckets,
    so that a conversation that owns a third of all turns is not sorted by one task.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = written(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
            F.unhex(F.md5(key)).alias("token"), F.octet_length(text).cast("bigint").alias("size"),
            F.floor(F.col("turn").cast("bigint") / TURNS_PER_BUCKET).alias("_bucket"),
        ),
        "turns",
    )
    order = [F.asc_nulls_first("turn"), F.asc("token")]
    before = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    shifts = turns.groupBy("conv_id", "_bucket").count().withColumn("_shift", F.sum("count").over(before)).where("_shift > 0")
    shifts = shifts.select(F.col("conv_id").alias("_conv"), F.col("_bucket").alias("_of"), "_shift")
    ranked = turns.withColumn("_local", F.row_number().over(Window.partitionBy("conv_id", "_bucket").orderBy(*order)))
    shifted = ranked.join(shifts, (F.col("conv_id") == F.col("_conv")) & F.col("_bucket").eqNullSafe(F.col("_of")), "left")
    return shifted.select("conv_id", (F.col("_local") - 1 + F.coalesce("_shift", F.lit(0))).cast("bigint").alias("pos"), "token", "size")


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns of the rebuilt conversations, (conv_id, pos, token, size, total), and the conversations, (conv_id, total).

    The first h turns come from the first conversation of the family, h being a checksum of the
    id; the conversation's own turns follow after its first h. Of a family's first conversation
    no more than `MOST_TAKEN` - 1 turns travel.
    """
    turns = written(numbered_turns(conversations), "numbered")
    head = F.sort_array(F.collect_list(F.when(F.col("pos") < MOST_TAKEN - 1, F.struct("pos", "token", "size"))))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), head.alias("head"))
    first = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = convs.where(first == F.col("conv_id")).select(F.col("conv_id").alias("_first"), F.col("head").alias("_head"))
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_TAKEN
    convs = convs.select("conv_id", "n", first.alias("_first"), h.alias("h")).join(heads, "_first", "left")
    convs = convs.withColumn("taken", F.expr("slice(coalesce(_head, array()), 1, cast(h AS INT))"))
    k = F.size("taken").cast("bigint")
    convs = written(convs.select("conv_id", "h", "taken", k.alias("k"), (k + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("total")), "rebuilt")
    taken = convs.select("conv_id", "total", F.explode("taken").alias("t")).select("conv_id", "t.pos", "t.token", "t.size", "total")
    own = turns.join(convs.select("conv_id", "h", "k", "total"), "conv_id").where("pos >= h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "token", "size", "total")
    return taken.unionByName(own), convs.select("conv_id", "total")


def _chained(tree: bytes, tokens: list[bytes]) -> bytes:
    return hashlib.blake2b(tree + b"".join(tokens), digest_size=NAME).digest()


def prefix_names(tree: bytes, end: bytes | None, tokens: list[bytes], height: int) -> list[bytes]:
    """Names of all prefixes of `tokens` that hang below the prefix named `tree`, the empty one included.

    A trie of some height is cut at half of it: what lies above the cut keeps the trie's name,
    and each prefix of that depth names the trie that hangs below it. All tries of one
    height are cut together, from `height` down to 1, so a name takes as many steps as the
    height has bits. `end` is the name of the whole, where it is given from above.
    """
    names: dict[int, bytes] = {0: tree}
    if len(tokens) == height:
        names[height] = end or _chained(tree, tokens)
    half = height // 2
    while half:
        for cut in range(half, len(tokens) + 1, 2 * half):
            names[cut] = _chained(names[cut - half], tokens[cut - half : cut])
        half //= 2
    return [names[d] for d in range(len(tokens) + 1)]


def _above(names: list[bytes], depth: int) -> bytes:
    """Names of the nodes over a cut in its upper trie, the nearest first, and last that trie's own name."""
    return b"".join(reversed(names[depth - (depth & -depth) : depth]))


def _tiers(rows: DataFrame, segment: int, every: bool = False) -> list[DataFrame]:
    """Tries of sequences (conv_id, pos, token, size, total), the lowest tier first, each a stored table (`_TRIE`).

    Sequences are held by segments of at most `segment` tokens. Whole segments are the tokens of the next
    tier, which names the prefixes that end with them. Rows of kind node are distinct prefixes
    per task, with their members; end: where a sequence ends; at (if `every`): each prefix of each sequence.
    """
    seg = F.floor(F.col("pos") / segment)
    ordered = F.sort_array(F.collect_list(F.struct("pos", "token", "size")))
    held = rows.groupBy("conv_id", seg.alias("seg"), "total").agg(ordered.alias("turns"))
    held = held.select("conv_id", "seg", "total", F.col("turns.token").alias("tokens"), F.col("turns.size").alias("sizes"))
    longest = rows.agg(F.max("pos")).first()[0]
    if longest is None:
        longest = -1
    upper: list[DataFrame] = []
    if longest >= segment:
        held = written(held, "segments")
        whole = held.where(F.size("tokens") == segment)
        joined = F.concat_ws("", F.transform("tokens", F.hex))
        tokens = whole.select(
            "conv_id", F.col("seg").alias("pos"), F.unhex(F.md5(joined)).alias("token"), F.lit(0).cast("bigint").alias("size"),
            F.floor(F.col("total") / segment).alias("total"),
        )
        upper = _tiers(tokens, segment, True)
        at = upper[0].where("kind = 'at'")
        bounds = at.select("conv_id", F.col("pos").alias("seg"), F.col("parent").alias("tree"), F.col("name").alias("end")).unionByName(
            at.select("conv_id", (F.col("pos") + 1).alias("seg"), F.col("name").alias("tree"), F.lit(None).cast("binary").alias("end"))
        )
        bounds = bounds.groupBy("conv_id", "seg").agg(F.max("tree").alias("tree"), F.max("end").alias("end"))
        held = held.join(bounds, ["conv_id", "seg"], "left")
    else:
        held = held.withColumns({"tree": F.lit(None).cast("binary"), "end": F.lit(None).cast("binary")})
    height = 1 << max(0, min(segment, longest + 1) - 1).bit_length()

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes: dict[bytes, list] = {}
        others: list[tuple] = []

        def out() -> pa.RecordBatch:
            found = [("node", name, *rest, None) for name, rest in nodes.items()] + others
            columns = list(zip(*found)) or [()] * 9
            kinds = [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            got = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], [f.split()[0] for f in _TRIE.split(", ")])
            nodes.clear()
            others.clear()
            return got

        for batch in batches:
            read = (batch.column(c).to_pylist() for c in ("conv_id", "seg", "total", "tokens", "sizes", "tree", "end"))
            for conv_id, seg, total, tokens, sizes, tree, end in zip(*read):
                names = prefix_names(tree or ROOT, end, tokens, height)
                start = seg * segment
                for d in range(1, len(names)):
                    name = names[d]
                    node = nodes.get(name)
                    if node is None:
                        nodes[name] = [names[d - 1], start + d, sizes[d - 1], _above(names, d), 1, conv_id]
                    else:
                        node[4] += 1
                        node[5] = min(node[5], conv_id)
                    if every:
                        others.append(("at", name, names[d - 1], None, None, None, None, conv_id, start + d - 1))
                if start + len(tokens) == total:
                    others.append(("end", names[-1], None, None, None, None, None, conv_id, None))
                if len(nodes) + len(others) >= BLOCK_NODES:
                    yield out()
        yield out()

    return [written(held.mapInArrow(build, _TRIE), "trie"), *upper]


def _nodes(tier: DataFrame) -> DataFrame:
    keys = ["name", "parent", "depth", "size", "above"]
    return tier.where("kind = 'node'").groupBy(*keys).agg(F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"))


def _hung_on(hanging: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add what hangs below each cut, rows (parent, leaves, saved), to the cut and to the nodes over it in its upper trie."""
    met = cuts.join(hanging.withColumnRenamed("parent", "name"), "name")
    chain = F.concat("name", "above")
    steps = met.withColumn("i", F.explode(F.sequence(F.lit(0), F.expr(f"cast(octet_length(above) div {NAME} - 1 AS INT)")))).withColumn("chain", chain)
    part = lambda shift: F.expr(f"substring(chain, (i + {shift}) * {NAME} + 1, {NAME})")
    steps = steps.select(part(0).alias("name"), part(1).alias("parent"), (F.col("depth") - F.col("i")).alias("depth"), "leaves", "saved")
    return steps.groupBy("name", "parent", "depth").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def _grafted(tiers: list[DataFrame], segment: int) -> DataFrame:
    """Per node, rows (name, leaves, saved) that sum up to the totals of its subtree.

    `tiers` hold nodes (name, parent, depth, above, leaves, saved), the lowest first, with their own values in
    the lowest. Tries of height 2, 4, 8, … are completed one after the other: what the tries below a
    cut add up to is grafted onto the cut and the nodes over it in the upper trie, all cuts
    of a height at once. A tier's whole segments then take over what the next tier adds up.
    """
    nodes = tiers[0]
    values = ["name", "parent", "depth", "leaves", "saved"]
    parts = [nodes.select(values)]
    deepest = nodes.agg(F.max("depth")).first()[0] or 0

    def sums(condition: Column) -> DataFrame:
        rows = reduce(DataFrame.unionByName, parts).where(condition)
        return rows.groupBy("parent").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))

    inside, below = F.col("depth") % segment, (F.col("depth") - 1) % segment
    half = 1
    while half < min(segment, deepest):
        cuts = nodes.where((_low_bit(F.col("depth")) == half) & (inside != 0)).select("name", "depth", "above")
        parts.append(written(_hung_on(sums((below != 0) & (_low_bit(F.col("depth") - 1) == half)), cuts), "graft"))
        half *= 2
    if len(tiers) > 1:
        own = sums((below == 0) & (F.col("depth") > 1))
        upper = tiers[1].drop("leaves", "saved").join(own.withColumnRenamed("parent", "name"), "name", "left").fillna(0, ["leaves", "saved"])
        totals = _grafted([written(upper, "graft"), *tiers[2:]], segment).groupBy("name").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        ends = nodes.where(inside == 0).select("name", "depth", "above")
        parts.append(written(_hung_on(totals.withColumnRenamed("name", "parent"), ends), "graft"))
    return reduce(DataFrame.unionByName, parts).select("name", "leaves", "saved", "depth")


def _ends(ends: DataFrame) -> DataFrame:
    """Rows (name, ends_sha256) from rows (name, conv_id): ids are joined in chunks, chunks hashed as a stream in order."""
    chunk = F.floor(F.col("conv_id") / IDS_PER_CHUNK)
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    chunks = ends.groupBy("name", chunk.alias("chunk")).agg(ids.alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state, names, found = None, None, [], []
        for batch in batches:
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if name == last:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    names.append(last)
                    found.append(state.hexdigest())
                last, state = name, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], ["name", "ends_sha256"])
            names, found = [], []
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], ["name", "ends_sha256"])

    in_order = chunks.repartition("name").sortWithinPartitions("name", "chunk").select("name", "ids")
    return in_order.mapInArrow(digest, "name binary, ends_sha256 string")


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Nodes of the prefix trie of rebuilt conversations (conv_id, turn, role, text).

    A conversation's turns are ordered by turn, nulls first, equal ones by a digest; a null role
    or text is empty. The first h turns are taken from the first conversation of the family
    of `FAMILY` ids. A node is a distinct sequence of first turns, from the empty one (depth 0).

    Rows (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256), one per node:
    the smallest member and its number of members, the parent's smallest member (null for the
    root), children, childless nodes of the subtree, bytes that sharing saves in the subtree,
    and the SHA-256 of the ids that end here. Rows without a conv_id belong to no
    conversation; repeated rows are turns each; without conversations there are no rows, not
    even a root; further columns are not used.
    """
    rows, convs = rebuilt_turns(conversations)
    tiers = _tiers(rows, segment)
    found = _nodes(tiers[0])
    children = found.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    nodes = found.join(children, "name", "left").fillna(0, ["n_children"])
    nodes = nodes.withColumns({"leaves": (F.col("n_children") == 0).cast("bigint"), "saved": (F.col("n_convs") - 1) * F.col("size")})
    nodes = written(nodes, "nodes")
    grafts = _grafted([nodes, *[_nodes(t).withColumns({"leaves": F.lit(0), "saved": F.lit(0)}) for t in tiers[1:]]], segment)
    totals = grafts.groupBy("name").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    none = convs.where("total = 0").select(F.lit(ROOT).alias("name"), "conv_id")
    ends = _ends(tiers[0].where("kind = 'end'").select("name", "conv_id").unionByName(none))
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = nodes.join(totals, "name").join(parents, "parent", "left")
    below = below.select("name", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    least, n_convs = convs.agg(F.min("conv_id"), F.count("*")).first()
    over = F.when(F.col("depth") == 1, F.lit(least).cast("bigint")).otherwise(F.col("parent_conv_id"))
    below = below.withColumn("parent_conv_id", over)
    top = grafts.where("depth = 1").agg(F.coalesce(F.sum("leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved"), F.lit(0)).alias("saved_tokens"))
    root = top.where(F.lit(n_convs > 0)).select(
        F.lit(ROOT).alias("name"), F.lit(least).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(None).cast("bigint").alias("parent_conv_id"), F.lit(n_convs).cast("bigint").alias("n_convs"),
        F.lit(nodes.where("depth = 1").count()).cast("bigint").alias("n_children"), "n_leaves", "saved_tokens",
    )
    every = below.unionByName(root).join(ends, "name", "left")
    return every.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(RESULT)
