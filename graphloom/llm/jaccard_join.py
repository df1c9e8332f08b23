"""Exact Jaccard self-join on distinct n-gram sets, as a blocked sparse product of the document by n-gram incidence.

Copies of one set are one row of the incidence matrix. Its columns are ordered by how common they are, by a sketch of
column counts over all documents. Two sets of the wanted similarity share one of the rarest columns of each (the prefix
that the size-derived bound leaves), so only sets that meet in a prefix column can have an overlap that counts.

Every prefix column with several sets picks its best connected set as leader, and a leader's block is all sets that meet
it in such a column: each pair to be tested lies in the block of some leader. First each set's overlap with its leader is
counted. The sets that are linked with it need no further test among each other; the rest of a block is multiplied with
the whole block in tiles of bounded rows and bytes, without the rows whose prefix columns are too few for every size in the
block. A tile adds up overlap counts over blocks of columns, drops pairs whose
overlap and remaining columns stay below the bound that their sizes give, and returns a spanning set of its links. So a
large group of near copies costs a pass over it, and neither its pairs nor its members are ever in one task.

Both steps count over the prefix columns first, which are few. Of two prefixes, take the one that ends first in the column
order: what it shares with the other set, it shares with the other's prefix. So a pair that reaches the wanted overlap
shares ``least_met`` prefix columns, and whole sets are sent only for pairs that do.

A document with fewer than five words has its whole sequence as one n-gram; one without words is linked with nothing.
Rows with a null id have a null component and link nothing. Rows with one id and several texts are one document: what links
with one of its texts is linked with all of them. A long text's set is whole. An empty table gives an empty result; further columns are not
read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.components import connected_components
from graphloom.llm.elias_fano import EliasFano, encode
from graphloom.llm.shared import kept_files, make_dirs, map_file, put_file, shared_dir, text_batches, written
from graphloom.llm.words import hashed_steps, row_shingles, texts_of

#: Buckets of the column-count sketch and the slices in which it is summed; both fixed.
BUCKETS, SLICES = 1 << 20, 64
#: Bytes and rows of sets on one side of a tile, columns that a tile adds up at once, and pairs of which it holds counts.
TILE_BYTES, TILE_ROWS, TILE_COLUMNS, TILE_PAIRS = 4 << 20, 2048, 4096, 1 << 20
#: Bits that name a column among the shared ones, columns of all prefixes to a shard, and columns held by a task.
KEY_BITS, SHARD_COLUMNS, FLUSH_COLUMNS = 48, 1 << 20, 1 << 21
#: Most bits of the map of documents that take part in some block.
MAP_BITS = 1 << 27


def sets_of(column: pa.Array):
    """(first row, [sorted distinct n-grams of each row]) for runs of rows."""
    for row, _, words, bounds in hashed_steps(column):
        yield row, [np.unique(s) for s in row_shingles(words, bounds)]


def least_overlap(a, b, percent: int):
    """The overlap that sets of these sizes need: 100 * overlap >= percent * (a + b - overlap)."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def least_met(a, b, percent: int):
    """The prefix columns that two sets of these sizes share if they are linked (1 at least)."""
    return np.maximum(1, least_overlap(a, b, percent) + percent * -np.maximum(a, b) // 100 + 1)


def _profile(docs: DataFrame) -> DataFrame:
    """Rows (id, n, sig) of every document, and slices of each task's column counts."""

    def run(batches):
        counts = np.zeros(BUCKETS, np.int64)
        for b in batches:
            ids = b.column(0)
            for row, sets in sets_of(texts_of(b.column(1))):
                if sets:
                    counts += np.bincount((np.concatenate(sets) >> np.uint64(44)).astype(np.int64), minlength=BUCKETS)
                n = pa.array([s.size for s in sets], pa.int64())
                sig = pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary())
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays([ids.slice(row, len(sets)), n, sig, none.cast(pa.int32()), none.cast(pa.binary())], ["id", "n", "sig", "slice", "counts"])
        for k, part in enumerate(counts.reshape(SLICES, -1)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([k], pa.int32()), pa.array([part.astype("<u4").tobytes()])], ["id", "n", "sig", "slice", "counts"])

    return docs.mapInArrow(run, "id long, n long, sig binary, slice int, counts binary")


def _column_order(profile: DataFrame) -> np.ndarray:
    """A rank for every bucket: how common its columns are, in sixteenths of a doubling. Of fixed size."""

    def add(group):
        total = np.zeros(BUCKETS // SLICES, np.int64)
        for part in group.column(1).to_pylist():
            total += np.frombuffer(part, "<u4")
        return pa.table({"slice": group.column(0)[:1], "counts": pa.array([np.rint(16 * np.log2(total + 1)).astype("<u2").tobytes()])})

    order = np.zeros((SLICES, BUCKETS // SLICES), np.uint16)
    for r in profile.where("slice is not null").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, counts binary").collect():
        order[r["slice"]] = np.frombuffer(r["counts"], "<u2")
    return order.reshape(-1)


def _prefix(s: np.ndarray, rank: np.ndarray, percent: int) -> np.ndarray:
    """The prefix of a set's columns, rarest first."""
    return s[np.lexsort((s, rank[(s >> np.uint64(44)).astype(np.int64)]))[: prefix_length(s.size, percent)]] if s.size else s


def _short(columns: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard of each column by its first bits, and its next bits as the key there: ``KEY_BITS`` in all."""
    return (columns >> np.uint64(64 - bits)).astype(np.int64), (columns >> np.uint64(64 - KEY_BITS)) & np.uint64((1 << (KEY_BITS - bits)) - 1)


@kept_files
def _shared_keys(name: str) -> EliasFano:
    return EliasFano(np.frombuffer(map_file(name), np.uint8))


def _shared_columns(docs: DataFrame, sent, percent: int, bits: int) -> dict[int, str]:
    """Files with the prefix columns that occur in several documents (and a few others), by shard.

    Tasks send their distinct columns as Elias-Fano coded blocks, so a common column is one entry a block. A column is
    named by ``KEY_BITS`` bits there: two columns of one name count as shared, which costs a test and loses nothing.
    """
    folder = shared_dir(docs.sparkSession)
    make_dirs(folder)
    universe = 1 << (KEY_BITS - bits)

    def run(batches):
        held, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held) >> np.uint64(64 - KEY_BITS), return_counts=True)
            shard, keys = _short(keys << np.uint64(64 - KEY_BITS), bits)
            names, first = np.unique(shard, return_index=True)
            cuts = [*first.tolist(), keys.size]
            rows = [(encode(keys[a:b], universe), np.packbits(counts[a:b] > 1).tobytes()) for a, b in zip(cuts, cuts[1:], strict=False)]
            return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], ["shard", "keys", "again"])

        for b in batches:
            for _, sets in sets_of(texts_of(b.column(1))):
                held += [_prefix(s, sent.value, percent) for s in sets if s.size]
                n += sum(x.size for x in held[-len(sets) :])
                if n >= FLUSH_COLUMNS:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()

    def write(group):
        keys, again = [], []
        for x, more in zip(group.column("keys").to_pylist(), group.column("again").to_pylist(), strict=True):
            keys.append(EliasFano(np.frombuffer(x, np.uint8)).values())
            again.append(keys[-1][np.unpackbits(np.frombuffer(more, np.uint8), count=keys[-1].size) == 1])
        flat = np.sort(np.concatenate(keys))
        met = np.unique(np.concatenate([flat[1:][flat[1:] == flat[:-1]], *again]))
        shard = group.column("shard")[0].as_py()
        return pa.table({"shard": pa.array([shard], pa.int32()), "name": [put_file(folder, f"columns-{shard:05d}.ef", [encode(met, universe)])]})

    blocks = docs.mapInArrow(run, "shard int, keys binary, again binary")
    return {r["shard"]: r["name"] for r in blocks.groupBy("shard").applyInArrow(write, "shard int, name string").collect()}  # a row a shard


def _met(docs: DataFrame, sent, percent: int, bits: int, files: dict[int, str]) -> DataFrame:
    """(id, n, columns): each document's prefix columns that several documents have; documents without any are left out."""

    def run(batches):
        for b in batches:
            for row, sets in sets_of(texts_of(b.column(1))):
                short = [_prefix(s, sent.value, percent) for s in sets]
                owner = np.repeat(np.arange(len(sets)), [x.size for x in short])
                flat = np.concatenate(short) if owner.size else np.zeros(0, np.uint64)
                shard, keys = _short(flat, bits)
                met = np.zeros(flat.size, bool)
                order = np.argsort(shard, kind="stable")
                for part in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if flat.size else []:
                    if (s := int(shard[part[0]])) in files:
                        met[part] = _shared_keys(files[s]).find(keys[part]) >= 0
                counts = np.bincount(owner[met], minlength=len(sets))
                rows = np.flatnonzero(counts)
                ends = np.concatenate([[0], np.cumsum(counts[rows])]).astype(np.int32)
                n = pa.array([sets[i].size for i in rows.tolist()], pa.int64())
                columns = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat[met].view(np.int64)))
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows + row)), n, columns], ["id", "n", "columns"])

    return docs.mapInArrow(run, "id long, n long, columns array<long>")


def _bit_map(ids: DataFrame, n: int) -> np.ndarray:
    """A map of hashed ids: True for all of ``ids``, and seldom for others. At most ``MAP_BITS`` bits."""
    bits = min(MAP_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    parts = min(4096, bits >> 10)
    place = F.pmod(F.xxhash64("id"), F.lit(bits))

    def gather(group):
        own = np.zeros(bits // parts, bool)
        own[group.column(1).to_numpy() % (bits // parts)] = True
        return pa.table({"part": group.column(0)[:1], "bits": pa.array([np.packbits(own).tobytes()])})

    found = np.zeros((parts, bits // parts // 8), np.uint8)
    slots = ids.select(place.alias("place")).distinct().select(F.expr(f"cast(place div {bits // parts} as int)").alias("part"), "place")
    for r in slots.groupBy("part").applyInArrow(gather, "part int, bits binary").collect():
        found[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return found.reshape(-1)


def _sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, n, columns) of the documents in ``ids`` (and a few others), columns as sorted bytes."""
    found = _bit_map(ids, ids.count())
    sent = docs.sparkSession.sparkContext.broadcast(found)
    bits = found.size * 8

    def run(batches):
        taken = sent.value
        for b in batches:
            place = b.column(2).to_numpy()
            keep = pa.array((taken[place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1 == 1)
            ids, texts = b.column(0).filter(keep), texts_of(b.column(1).filter(keep))
            for row, sets in sets_of(texts):
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(sets)), pa.array([s.size for s in sets], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], ["id", "n", "columns"]
                )

    placed = docs.select("id", "text", F.pmod(F.xxhash64("id"), F.lit(bits)).alias("place"))
    return placed.mapInArrow(run, "id long, n long, columns binary")


def tile_overlaps(left: list[np.ndarray], right: list[np.ndarray], need: np.ndarray) -> np.ndarray:
    """Which pairs (left, right) share ``need`` columns: overlap counts added up over blocks of columns."""
    sizes = np.array([s.size for s in left], np.int64), np.array([s.size for s in right], np.int64)
    alive = need <= np.minimum(sizes[0][:, None], sizes[1][None, :])
    if not alive.any():
        return alive
    owners = [np.repeat(np.arange(len(side)), n) for side, n in zip((left, right), sizes, strict=True)]
    flat = np.concatenate([*left, *right])
    _, columns = np.unique(flat, return_inverse=True)
    cut = owners[0].size
    columns = columns[:cut], columns[cut:]
    n = int(max(c.max(initial=-1) for c in columns)) + 1
    shared = (np.bincount(columns[0], minlength=n) > 0) & (np.bincount(columns[1], minlength=n) > 0)
    number = np.cumsum(shared) - 1
    parts = [(o[shared[c]], number[c[shared[c]]]) for o, c in zip(owners, columns, strict=True)]
    width = int(shared.sum())
    rest = [np.bincount(o, minlength=len(side)).astype(np.int64) for (o, _), side in zip(parts, (left, right), strict=True)]
    overlap = np.zeros(need.shape, np.float32)
    for a in range(0, width, TILE_COLUMNS):
        alive &= overlap + np.minimum(rest[0][:, None], rest[1][None, :]) >= need
        if not alive.any():
            return alive
        dense = []
        for k, (o, c) in enumerate(parts):
            here = (c >= a) & (c < a + TILE_COLUMNS)
            m = np.zeros((need.shape[k], min(TILE_COLUMNS, width - a)), np.float32)
            m[o[here], c[here] - a] = 1
            rest[k] -= np.bincount(o[here], minlength=need.shape[k])
            dense.append(m)
        overlap += dense[0] @ dense[1].T
    return alive & (overlap >= need)


def spanning(hits: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that join the same documents as all ``hits`` do, at most one for each document but one."""
    ids, place = np.unique(np.concatenate([left, right]), return_inverse=True)
    root, out = np.arange(ids.size), []
    a, b = place[: left.size], place[left.size :]
    for i in np.flatnonzero(hits.any(1)).tolist():
        new = b[hits[i]]
        new = new[root[new] != root[a[i]]]
        if new.size:
            roots, first = np.unique(root[new], return_index=True)
            out += [(int(left[i]), int(ids[new[f]])) for f in first.tolist()]
            root[np.isin(root, roots)] = root[a[i]]
    return out


def _may_link(percent: int):
    """Column test of (mine, theirs, n, leader_n): sizes and shared prefix columns allow a link."""
    least = F.expr(f"cast(ceil({percent}L * (n + leader_n) / {100 + percent}D) as long)")
    met = F.greatest(F.lit(1), least - F.expr(f"cast(ceil({percent}L * greatest(n, leader_n) / 100D) as long)") + 1)
    return (least <= F.least("n", "leader_n")) & (F.size(F.array_intersect("mine", "theirs")) >= met)


def _joined(pairs: DataFrame, table: DataFrame) -> DataFrame:
    """``pairs`` (leader, member) with size and columns of both ends from ``table`` (id, n, columns)."""
    member = table.select(F.col("id").alias("member"), "n", F.col("columns").alias("mine"))
    leader = table.select(F.col("id").alias("leader"), F.col("n").alias("leader_n"), F.col("columns").alias("theirs"))
    return pairs.join(member, "member").join(leader, "leader")


def _star_links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs`` (leader, member)."""

    def run(batches):
        for b in batches:
            mine, theirs = b.column(2).to_pylist(), b.column(3).to_pylist()
            hit = []
            for x, y in zip(mine, theirs, strict=True):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                need = int(least_overlap(p.size, q.size, percent))
                hit.append(need <= min(p.size, q.size) and np.intersect1d(p, q, assume_unique=True).size >= need)
            keep = pa.array(hit, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["leader", "member"])

    return _joined(pairs, sets).select("leader", "member", "mine", "theirs").mapInArrow(run, "leader long, member long")


def _tiles(rows: DataFrame, table: DataFrame, bytes_of, kernel, fields: str) -> DataFrame:
    """``kernel`` on every tile of every block: rows (leader, member, left) of which the left ones meet all of the block."""
    rows = rows.join(table.select(F.col("id").alias("member"), "n", bytes_of.alias("_bytes"), "columns"), "member")
    sizes = rows.groupBy("leader").agg(
        F.sum(F.when(F.col("left"), F.col("_bytes"))).alias("ls"), F.sum("_bytes").alias("rs"), F.count_if("left").alias("lefts"), F.count("*").alias("members")
    )
    tiles = lambda size, n: F.greatest(F.lit(1), F.ceil(F.col(size) / TILE_BYTES), F.ceil(F.col(n) / TILE_ROWS)).cast("int").alias(size)
    rows = rows.join(sizes.where("ls is not null and members > 1").select("leader", tiles("ls", "lefts"), tiles("rs", "members")), "leader")
    mine = lambda n: F.pmod(F.xxhash64("member"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    # A tile (i, j) has the left rows of part i and all rows of part j.
    as_right = F.transform(every("ls"), lambda i: F.struct(i.alias("i"), mine("rs").alias("j"), F.lit(False).alias("is_left")))
    as_left = F.transform(every("rs"), lambda j: F.struct(mine("ls").alias("i"), j.alias("j"), F.lit(True).alias("is_left")))
    places = F.when(F.col("left"), F.concat(as_right, as_left)).otherwise(as_right)
    dealt = rows.select("leader", "member", "n", "columns", F.explode(places).alias("at")).select("leader", "at.i", "at.j", "at.is_left", "member", "n", "columns")
    return dealt.groupBy("leader", "i", "j").applyInArrow(kernel, fields)


def _sides(group: pa.Table):
    """Rows of the tile's left and right side: (ids, sizes, places in the group) of each."""
    is_left = group.column("is_left").to_numpy()
    ids, n = group.column("member").to_numpy(), group.column("n").to_numpy()
    return [(ids[at], n[at], at) for at in (np.flatnonzero(is_left), np.flatnonzero(~is_left))]


def _hits(columns: list[np.ndarray], left, right, need) -> np.ndarray:
    """Which pairs of the two sides are of two documents that share ``need`` (of both sizes) columns; counts of ``TILE_PAIRS`` pairs at once."""
    (ids, n, at), (other_ids, other_n, other_at) = left, right
    hits = np.zeros((at.size, other_at.size), bool)
    theirs, step = [columns[i] for i in other_at], max(1, TILE_PAIRS // max(1, other_at.size))
    for a in range(0, at.size if other_at.size else 0, step):
        least = need(n[a : a + step, None], other_n[None, :])
        least[ids[a : a + step, None] == other_ids[None, :]] = 1 << 60
        hits[a : a + step] = tile_overlaps([columns[i] for i in at[a : a + step]], theirs, least)
    return hits


def _fitting(blocks: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """The rows of ``blocks`` with as many prefix columns as a link with some size in their block needs."""
    rows = blocks.join(met.select(F.col("id").alias("member"), "n", F.size("columns").alias("degree")), "member")
    sizes = rows.groupBy("leader", "n").agg(F.max("left").alias("left"), F.count("*").alias("rows"))
    each = sizes.groupBy("leader").agg(F.collect_list(F.struct("n", "left", "rows")).alias("sizes")).where("exists(sizes, x -> x.left)")
    overlap = f"({percent} * (a.n + b.n) + {99 + percent}) div {100 + percent}"
    fits = f"(a.left or b.left) and (a.n <> b.n or a.rows > 1) and {overlap} <= least(a.n, b.n)"
    shared = f"greatest(1, {overlap} - ({percent} * greatest(a.n, b.n) + 99) div 100 + 1)"
    least = f"inline(transform(sizes, a -> named_struct('n', a.n, 'least', array_min(transform(filter(sizes, b -> {fits}), b -> {shared})))))"
    return rows.join(each.selectExpr("leader", least).where("least is not null"), ["leader", "n"]).where("degree >= least").select("leader", "member", "left")


def _tile_hopes(blocks: DataFrame, met: DataFrame, percent: int) -> DataFrame:
    """Rows (leader, member, left) that may still have a link in their block, by their prefix columns."""

    def need(n, other_n):
        return np.where(least_overlap(n, other_n, percent) <= np.minimum(n, other_n), least_met(n, other_n, percent), 1 << 60)

    def kernel(group):
        left, right = _sides(group)
        lists = group.column("columns").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        columns = [flat[a:b] for a, b in zip(ends, ends[1:], strict=False)]
        hits = _hits(columns, left, right, need)
        a, b = left[0][hits.any(1)], right[0][hits.any(0)]
        leader = group.column("leader")[0].as_py() if group.num_rows else 0
        return pa.table({"leader": np.full(a.size + b.size, leader, np.int64), "member": np.concatenate([a, b]), "left": np.arange(a.size + b.size) < a.size})

    hopes = _tiles(_fitting(blocks, met, percent), met, F.size("columns") * 8, kernel, "leader long, member long, left boolean")
    return hopes.groupBy("leader", "member").agg(F.max("left").alias("left"))


def _tile_links(hopes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of each block's left rows with all its rows."""

    def kernel(group):
        left, right = _sides(group)
        columns = [np.frombuffer(x, np.uint64) for x in group.column("columns").to_pylist()]
        hits = _hits(columns, left, right, lambda n, other_n: least_overlap(n, other_n, percent))
        out = spanning(hits, left[0], right[0])
        return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})

    return _tiles(hopes, sets, F.octet_length("columns"), kernel, "a long, b long")


def _links_by_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of texts that share an id."""
    several = rows.where("n > 0 and id is not null").groupBy("id").agg(F.min("sig").alias("x"), F.max("sig").alias("y")).where("x <> y").select("id")
    reps = rows.where("n > 0").join(several, "id", "left_semi").join(classes, "sig").groupBy("id").agg(F.collect_set("rep").alias("reps"))
    return reps.select(F.explode("reps").alias("a"), F.array_min("reps").alias("b")).where("a <> b")


def jaccard_components(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row: the smallest id reachable by links of at least ``percent`` similarity."""
    text_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    profile = written(_profile(docs))
    rows = profile.where("n is not null").select("id", "n", "sig")
    classes = written(rows.where("n > 0 and id is not null").groupBy("sig").agg(F.min("id").alias("rep")))
    texts = docs.where("id is not null")

    order = docs.sparkSession.sparkContext.broadcast(_column_order(profile))
    total = rows.agg(F.sum("n")).first()[0] or 0
    bits = max(3, (total * (100 - percent) // 100 // SHARD_COLUMNS).bit_length())
    files = _shared_columns(texts, order, percent, bits)
    reps = classes.select(F.col("rep").alias("id")).distinct()
    met = written(_met(texts, order, percent, bits, files).join(reps, "id", "left_semi"))
    spread = met.select("id", F.size("columns").alias("degree"), F.explode("columns").alias("column"))
    leaders = spread.groupBy("column").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("leader"))
    blocks = written(spread.join(leaders, "column").where("id <> leader").select("leader", F.col("id").alias("member")).distinct())

    ends = lambda pairs: pairs.select(F.col("leader").alias("id")).unionByName(pairs.select(F.col("member").alias("id"))).distinct()
    near = written(_joined(blocks, met).where(_may_link(percent)).select("leader", "member"))
    stars = written(_star_links(near, written(_sets(texts, ends(near))), percent))
    rest = blocks.join(stars.withColumn("linked", F.lit(True)), ["leader", "member"], "left").select("leader", "member", F.col("linked").isNull().alias("left"))
    hopes = written(_tile_hopes(rest, met, percent))
    tiled = _tile_links(hopes, _sets(texts, ends(hopes)), percent)
    links = stars.select(F.col("leader").alias("a"), F.col("member").alias("b")).unionByName(tiled).unionByName(_links_by_id(rows, classes))
    found = written(connected_components(links))

    named = classes.join(found, classes["rep"] == found["node"], "left").select("sig", F.coalesce("component", "rep").alias("component"))
    out = rows.join(named, "sig", "left")
    component = F.when(F.col("id").isNotNull(), F.least(F.coalesce("component", "id"), "id"))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
