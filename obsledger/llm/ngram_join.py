"""Grouped prefix join on word shingles: exact Jaccard links and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsledger.llm.graph import connected_components
from obsledger.llm.text import U64, mix, shingle_sets
from obsledger.session import written

FREQUENT_DF = 16  # shingles in fewer documents keep their hash order
FREQUENT_LIMIT = 4_000_000  # of frequent shingles that can exist: one holds at least 1/limit of all occurrences
RANGE_BYTES = 8 << 20  # of text per hash range when shingles are counted
BLOCK_SHINGLES = 1 << 20  # that a task gathers before it hands on their counts
FILTER_WORDS = 1 << 20  # of 64 bits, in the filter that spares sets nobody asks for
TOKEN_SHIFT = 24  # counts are kept for the upper 40 bits of a shingle's hash


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, np.uint64)


def _signature(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """128 bits per segment that do not depend on the order inside it."""
    return np.stack([_sums(mix(hashes ^ U64(0x5851F42D4C957F2D)), starts), _sums(mix(hashes * U64(0xDA942042E4DD58B5)), starts)], 1)


def _row_keys(signatures: np.ndarray, doc_ids: pa.Array) -> np.ndarray:
    """64 bits from a set and its document, for the filter."""
    ids = doc_ids.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return (signatures[:, 0] ^ mix(ids)).view(np.int64)


def _range_bits(total_bytes: int) -> int:
    return min(16, max(4, int(total_bytes // RANGE_BYTES).bit_length()))


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 40-bit hashes in order and their counts. Empties `held` and sorts in place: little more than the hashes twice."""
    tokens = np.concatenate(held)
    held.clear()
    tokens >>= U64(TOKEN_SHIFT)
    tokens.sort()
    new = np.ones(len(tokens) + 1, bool)
    np.not_equal(tokens[1:], tokens[:-1], out=new[1:-1])
    counts = np.diff(np.flatnonzero(new)).astype(np.uint32)
    return tokens[new[:-1]], counts


def _set_views(column: pa.Array) -> list[np.ndarray]:
    """The sets of a column of hashes as bytes, where they are: no copy, since a batch of them is large."""
    column = column.cast(pa.large_binary())
    if not len(column):
        return []
    at = (np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] // 8).tolist()
    hashes = np.frombuffer(column.buffers()[2], np.uint64, count=at[-1])
    return [hashes[a:b] for a, b in zip(at, at[1:])]


def shingle_frequencies(docs: DataFrame, range_bits: int) -> DataFrame:
    """Rows (token, df) for shingles in `FREQUENT_DF` documents or more, and (-1, n) with n shingles in a hash range.

    Tasks hand on sorted blocks of 40-bit hashes and counts per hash range; a range is merged in
    one task and holds about `RANGE_BYTES` of text, however often a shingle occurs.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            tokens, counts = _counted(held)
            cuts = np.searchsorted(tokens, np.arange((1 << range_bits) + 1, dtype=np.uint64) << U64(40 - range_bits))
            filled = np.flatnonzero(np.diff(cuts))
            tokens &= U64((1 << 40 - range_bits) - 1)
            tokens = tokens.astype(np.uint32 if range_bits >= 8 else np.uint64, copy=False)
            parts = list(zip(cuts[filled].tolist(), cuts[filled + 1].tolist()))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(filled, pa.int32()),
                    pa.array([tokens[a:b].tobytes() for a, b in parts], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in parts], pa.binary()),
                ],
                ["_range", "tokens", "counts"],
            )

        for batch in batches:
            for _, _, _, hashes in shingle_sets(batch.column(0)):
                held.append(hashes)
                del hashes
                if sum(map(len, held)) >= BLOCK_SHINGLES:
                    yield out()
            del batch  # or it stays until the next one is there
        if sum(map(len, held)):
            yield out()

    def merge(group: pa.Table) -> pa.Table:
        width = np.uint32 if range_bits >= 8 else np.uint64
        base = group.column("_range")[0].as_py() << (40 - range_bits)
        tokens = np.concatenate([np.frombuffer(x, width) for x in group.column("tokens").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, np.uint32) for x in group.column("counts").to_pylist()])
        order = np.argsort(tokens, kind="stable")
        tokens, counts = tokens[order], counts[order]
        starts = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        df = np.add.reduceat(counts.astype(np.int64), starts)
        often = df >= FREQUENT_DF
        return pa.table(
            {
                "token": pa.array(np.append(tokens[starts][often].astype(np.int64) + base, -1), pa.int64()),
                "df": pa.array(np.append(df[often], df.sum()), pa.int64()),
            }
        )

    counted = docs.select("text").mapInArrow(blocks, "_range int, tokens binary, counts binary")
    return counted.groupBy("_range").applyInArrow(merge, "token bigint, df bigint")


def _bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the shingles' hashes in a power of two of bits, at least one bit each."""
    bits = 1 << max(6, int(len(hashes) - 1).bit_length())
    odd = np.bincount((hashes >> U64(7)).astype(np.int64) & (bits - 1), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def least_difference(a: bytes, b: bytes) -> int:
    """At least so many shingles are in only one of the two sets behind these bitmaps."""
    if len(a) < len(b):
        a, b = b, a
    x = int.from_bytes(a, "little")
    size = 8 * len(a)
    while size > 8 * len(b):  # a bitmap of half the size is the two halves' parity
        size //= 2
        x = (x >> size) ^ (x & ((1 << size) - 1))
    return (x ^ int.from_bytes(b, "little")).bit_count()


def signed_sets(docs: DataFrame, frequent: np.ndarray, df: np.ndarray) -> DataFrame:
    """Per row of `docs` (_row, doc_id, text, text_key): size n, signature of its set, prefix and its signature, bitmap, key.

    The order of shingles is by document frequency for frequent ones, after all others, which
    are ordered by hash. Two sets of Jaccard 0.75 or more share a shingle of their prefixes,
    the first n - ceil(3n/4) + 1.
    """
    shared = docs.sparkSession.sparkContext.broadcast((frequent, df))
    names = ["_row", "doc_id", "text_key", "n", "sig", "prefix_sig", "prefix", "bitmap", "key"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = shared.value
        for batch in batches:
            for start, end, rows, hashes in shingle_sets(batch.column("text")):
                n = np.bincount(rows, minlength=end - start)
                filled = np.flatnonzero(n)
                firsts = np.concatenate(([0], np.cumsum(n)))[:-1]
                sig = np.zeros((end - start, 2), np.uint64)
                sig[filled] = _signature(hashes, firsts[filled])
                rank = np.zeros(len(hashes), np.int64)
                if len(known):
                    token = (hashes >> U64(TOKEN_SHIFT)).astype(np.int64)
                    at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                    rank = np.where(known[at] == token, often[at], 0)
                order = np.lexsort((hashes, rank, rows))
                length = np.where(n > 0, n - (3 * n + 3) // 4 + 1, 0)
                picked = np.arange(len(rows)) - firsts[rows] < length[rows]
                prefix = hashes[order][picked]
                cuts = np.concatenate(([0], np.cumsum(length)))
                prefix_sig = np.zeros((end - start, 2), np.uint64)
                prefix_sig[filled] = _signature(prefix, cuts[:-1][filled])
                bitmaps = [_bitmap(hashes[firsts[i] : firsts[i] + n[i]]) if n[i] else b"" for i in range(end - start)]
                ids = batch.column("doc_id").slice(start, end - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("_row").slice(start, end - start),
                        ids,
                        batch.column("text_key").slice(start, end - start),
                        pa.array(n, pa.int64()),
                        pa.array([s.tobytes() for s in sig], pa.binary()),
                        pa.array([s.tobytes() for s in prefix_sig], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(prefix.view(np.int64))),
                        pa.array(bitmaps, pa.binary()),
                        pa.array(_row_keys(sig, ids)),
                    ],
                    names,
                )
            del batch

    return docs.mapInArrow(
        sign, "_row bigint, doc_id bigint, text_key binary, n bigint, sig binary, prefix_sig binary, prefix array<bigint>, bitmap binary, key bigint"
    )


def _may_link(n_a: Column, pos_a: Column, n_b: Column, pos_b: Column) -> Column:
    """Whether sets may link whose first common shingle has these places in their prefixes.

    What stands before it is in one set only, so the overlap is at most what is left of either
    set; 3/7 of both sizes together is needed. True links pass by the first shingle they share.
    """
    return 7 * F.least(n_a - pos_a, n_b - pos_b) >= 3 * (n_a + n_b)


def _asked_filter(keys: DataFrame) -> np.ndarray:
    """A filter of `FILTER_WORDS` * 64 bits over column `key`: of fixed size, and never wrong about a key that is in."""
    words = keys.groupBy(F.shiftrightunsigned(F.col("key"), 6).bitwiseAND(F.lit(FILTER_WORDS - 1)).cast("int").alias("w"))
    bits = words.agg(F.expr("bit_or(shiftleft(1L, cast(key & 63L as int)))").alias("bits")).toPandas()
    out = np.zeros(FILTER_WORDS, np.int64)
    out[bits["w"].to_numpy()] = bits["bits"].to_numpy()
    return out.view(np.uint64)


def _asked_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Rows (node, n, set) with the sorted shingle hashes of the wanted `nodes` (node, key, n), read from the texts again."""
    shared = docs.sparkSession.sparkContext.broadcast(_asked_filter(nodes))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for start, end, rows, hashes in shingle_sets(batch.column("text")):
                n = np.bincount(rows, minlength=end - start)
                firsts = np.concatenate(([0], np.cumsum(n)))
                filled = np.flatnonzero(n)
                sig = _signature(hashes, firsts[filled])
                key = _row_keys(sig, batch.column("doc_id").slice(start, end - start).take(pa.array(filled)))
                k = key.view(np.uint64)
                asked = (bits[(k >> U64(6)) & U64(FILTER_WORDS - 1)] >> (k & U64(63))) & U64(1) > 0
                at = filled[asked]
                sets = [hashes[firsts[i] : firsts[i + 1]].tobytes() for i in at]
                yield pa.RecordBatch.from_arrays([pa.array(key[asked]), pa.array(sets, pa.binary())], ["key", "set"])
            del batch

    found = docs.select("doc_id", "text").mapInArrow(pick, "key bigint, set binary")
    return found.join(nodes.select("node", "key"), "key").dropDuplicates(["node"]).select("node", "set")


def _linked(docs: DataFrame, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Of candidate `pairs` (a, b) those with 100 * |intersection| >= 75 * |union|; `nodes` has (node, n, bitmap, key).

    Sizes and bitmaps, which bound the overlap from above, settle most pairs; the sets of the
    others are compared in full.
    """
    about = nodes.select("node", "n", "bitmap", "key")
    a, b = (about.select(*[F.col(c).alias(f"{c}_{s}") for c in about.columns]) for s in "ab")
    sized = pairs.join(a, F.col("a") == F.col("node_a")).join(b, F.col("b") == F.col("node_b"))
    sized = sized.where(4 * F.least("n_a", "n_b") >= 3 * F.greatest("n_a", "n_b"))

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("n_a", "n_b", "bitmap_a", "bitmap_b")]
            keep = [7 * least_difference(x, y) <= n + m for n, m, x, y in zip(*columns)]
            yield batch.select(["a", "b", "key_a", "key_b"]).filter(pa.array(keep, pa.bool_()))

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(_set_views(batch.column("set_a")), _set_views(batch.column("set_b"))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    open_pairs = written(sized.mapInArrow(possible, "a bigint, b bigint, key_a bigint, key_b bigint"), "pairs")
    ends = open_pairs.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("key_a").alias("key")), F.struct(F.col("b").alias("node"), F.col("key_b").alias("key")))).alias("e"))
    sets = _asked_sets(docs, ends.select("e.node", "e.key").distinct())
    sets_a, sets_b = (sets.select(F.col("node").alias(s), F.col("set").alias(f"set_{s}")) for s in "ab")
    both = open_pairs.select("a", "b").join(sets_a, "a").join(sets_b, "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(alike, "a bigint, b bigint")


def _text_key() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def without_similar(docs: DataFrame) -> DataFrame:
    """Rows of `docs` (doc_id, text, further columns) but those similar to one of a smaller id: a document of each component stays.

    Rows are judged one by one: where one id has texts of several components, each text belongs to
    its own. Of a component the rows of its smallest id stay (repeated rows of one id are one
    document). Rows with a null id stay, and so do null and empty texts, which are similar to nothing.
    """
    later = _with_components(docs.select("doc_id", "text")).where("component_id <> doc_id").select("doc_id", "text_key").distinct()
    keyed = docs.withColumn("_text_key", _text_key())
    gone = (F.col("l.doc_id") == F.col("r.doc_id")) & (F.col("l._text_key") == F.col("r.text_key"))
    return keyed.alias("l").join(later.alias("r"), gone, "left_anti").drop("_text_key")


def similar_documents(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id), one for each row of `docs` (doc_id, text).

    Documents link when their sets of distinct five-word shingles have 100 * |intersection| >=
    75 * |union|; component_id is the smallest doc_id that links reach. A text of fewer words is
    one shingle; an empty or null text has none, links with nothing and is its own component.
    Null ids never name a component while another id is in it; repeated rows and equal ids keep
    a row each; no rows give no rows; further columns are not used.

    1. Shingle frequencies over all documents put common shingles last in every prefix.
    2. Equal sets become one node; nodes of the same size and prefix become one group.
    3. An index from prefix shingles to groups gives group pairs, as far as sizes and the places
       of the shingle in the prefixes allow. First every group meets one group per shingle it
       has, that in which the shingle comes first, so that large families of copies are linked
       by a number of pairs in proportion to their size; then, for shingles whose groups are not
       all in one component yet, groups are expanded to their members, and all pairs of
       members from different components are compared. Links inside a component are not
       needed to know it, all others are found: no group is capped or sampled.
    """
    return _with_components(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def _with_components(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text_key, n, component_id), one for each row of `docs`: see `similar_documents`."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    total_bytes = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    counts = written(shingle_frequencies(docs, _range_bits(total_bytes)), "shingles")
    occurrences = counts.where("token = -1").agg(F.sum("df")).first()[0] or 0
    least = max(FREQUENT_DF, -(-occurrences // FREQUENT_LIMIT))
    often = counts.where((F.col("token") >= 0) & (F.col("df") >= least)).toPandas().sort_values("token")
    signed = signed_sets(
        docs.withColumns({"_row": F.monotonically_increasing_id(), "text_key": _text_key()}), often["token"].to_numpy(np.int64), often["df"].to_numpy(np.int64)
    )
    signed = written(signed, "signed")
    filled = signed.where("n > 0")
    sets = filled.groupBy("sig").agg(F.min("_row").alias("node"))
    nodes = filled.select("_row", "n", "prefix_sig", "bitmap", "key").join(sets.select("node"), F.col("_row") == F.col("node"))
    groups = nodes.groupBy("prefix_sig", "n").agg(F.min("node").alias("gid"))
    nodes = written(nodes.join(groups, ["prefix_sig", "n"]).select("node", "gid", "n", "bitmap", "key"), "nodes")

    leaders = filled.select("_row", "n", "prefix").join(nodes.where("node = gid").select("gid"), F.col("_row") == F.col("gid"))
    index = leaders.select(F.posexplode("prefix").alias("pos", "token"), "gid", F.col("n").cast("int").alias("n"))
    here = Window.partitionBy("token")
    first = F.min(F.struct("pos", "gid", "n")).over(here)
    index = index.select("token", "gid", "n", "pos", first.alias("first"), F.count(F.lit(1)).over(here).alias("m"))
    index = written(index.where("m > 1").drop("m"), "index")

    near = index.where("gid <> first.gid").where(_may_link(F.col("n"), F.col("pos"), F.col("first.n"), F.col("first.pos")))
    near = near.select(F.col("first.gid").alias("a"), F.col("gid").alias("b"))
    inside = nodes.where("node <> gid").select(F.col("gid").alias("a"), F.col("node").alias("b"))
    links = written(_linked(docs, near.unionByName(inside).distinct(), nodes), "links")
    members = nodes.join(connected_components(links), "node", "left")
    members = written(members.select("node", "gid", "n", F.coalesce("component", "node").alias("c")), "members")

    # a group of several nodes is a place of its own where nodes meet, like a shingle
    places = index.select("token", "gid", "pos").join(members, "gid").select("token", "node", "n", "pos", "c")
    own = members.join(members.where("node <> gid").select("gid").distinct(), "gid", "left_semi")
    own = own.select(F.col("gid").alias("token"), "node", "n", F.lit(0).alias("pos"), "c")
    places = written(places.unionByName(own), "places")
    mixed = places.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("token")
    mixed = places.join(mixed, "token")
    x, y = (mixed.select("token", *[F.col(k).alias(f"{k}_{s}") for k in ("node", "n", "pos", "c")]) for s in "ab")
    apart = (F.col("c_a") < F.col("c_b")) & _may_link(F.col("n_a"), F.col("pos_a"), F.col("n_b"), F.col("pos_b"))
    crossing = x.join(y, "token").where(apart).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()
    more = _linked(docs, crossing, nodes)

    found = connected_components(links.unionByName(more))
    where = sets.join(found, "node", "left").select("sig", F.coalesce("component", "node").alias("c"))
    placed = signed.select("_row", "doc_id", "text_key", "n", "sig").join(where, "sig", "left")
    placed = placed.withColumn("c", F.when(F.col("n") > 0, F.col("c")).otherwise(-1 - F.col("_row")))
    smallest = placed.groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return placed.join(smallest, "c").select("doc_id", "text_key", "n", "component_id")
