"""Near-duplicate documents by a chosen-path set similarity join.

A document's set holds its distinct five-word shingles (A-Z lowered; fewer
words: the whole sequence as one).  Documents with the same set form one class
before anything else, so copies cost one row.  Every class gets ``WIDTH``
minwise values; a *token* is (coordinate, minwise value).  In each of
``TREES`` independent trees a node chooses one or two coordinates (4/3 on
average, the branching for which a pair at similarity 3/4 keeps one common
child on average) and its documents go to the child of their own token.
Nodes of at most ``SMALL`` documents are compared exhaustively on 128-bit
sketches; larger ones are compared with the node's pivot and branch again,
unless their members agree with the pivot on ``DENSE`` sketch bits on average:
at that similarity (5/8) most of a group would come through all levels
together, each member in several nodes of every level.  Such nodes, and what
is still large after ``DEPTH`` levels, are dealt to blocks, whose members are
all compared with each other and linked with the nearest ones.  Candidates
that survive the sketches are confirmed on the full sets.

Those links join most of such a node, and the rest is finished exactly: the
large nodes that end and share a pivot make a *cell*, and every member that is
not in its cell's main component is compared, on full sets, with every member
of the cell, in tiles of ``TILE`` shingles a side.  So no link between members
of a large node is lost.  The finish costs (members left open) x (members of the
cell): little where the pivot's links join the group, the square of the cell
where they don't.

A pair at the threshold shares a node of level d in one tree with probability
0.81, 0.69, 0.60, 0.53, 0.48 (d = 1..5): 16 trees miss it with probability
2e-12 to 3e-5, less for closer pairs.

Defined cases: a null or empty text, or one without words, has the empty set
and no links.  Rows with a null doc_id are kept, unlinked, with a null
component.  Rows that share a doc_id are one document holding all their sets.
Extra columns are ignored; an empty table gives an empty result.  Texts of any
length are taken whole: one document's shingles are held in memory at a time,
or one tile's.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import cut, mix, shingles
from tessera.llm.graph import components

WIDTH = 128          # minwise values of a set
TREES = 16
DEPTH = 5
SMALL = 24           # nodes up to this size are compared exhaustively
BLOCK = 512          # members of a block of a node that ends
NEAREST = 4          # links of each block member that are confirmed first
TILE = 200_000       # shingles of one side of a tile
SPLIT = 128          # pairs of one text that are confirmed together
DEAL = 64            # parts in which a hot key meets its number of parts
MAP = 1 << 26        # bits of the map of asked documents, at most (8 MB)
DENSE = 104          # mean agreement with the pivot from which a large node ends
SKETCH_MIN = 92      # of 128 sketch bits; at similarity 3/4: 112 +- 3.7 agree
NUM, DEN = 75, 100   # similarity threshold

_A = np.random.default_rng(77).integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minwise(s: np.ndarray) -> np.ndarray:
    """WIDTH minwise values (32 bits) of a non-empty set of 64-bit hashes."""
    out = np.full(WIDTH, 2**64 - 1, np.uint64)
    for i in range(0, len(s), 2048):
        out = np.minimum(out, (_A[:, None] * s[None, i:i + 2048]).min(axis=1))
    return (out >> np.uint64(32)).astype(np.uint32)


def _long(a) -> np.ndarray:
    return np.asarray(a, np.uint64).view(np.int64)


SETS = "doc_id long, n_shingles long, cid long, sig binary, s1 long, s2 long"


def _sketch(batches):
    for batch in batches:
        ids = batch.column(0)
        out = {k: [] for k in ("n", "cid", "sig", "s1", "s2")}
        for text in batch.column(1).to_pylist():
            s = shingles(text)
            out["n"].append(len(s))
            if not len(s):
                for k in ("cid", "sig", "s1", "s2"):
                    out[k].append(None)
                continue
            sig = minwise(s)
            bits = np.packbits((mix(sig.astype(np.uint64)) >> np.uint64(40)).astype(np.uint8) & 1).view(np.int64)
            out["cid"].append(int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True))
            out["sig"].append(sig.tobytes())
            out["s1"].append(int(bits[0]))
            out["s2"].append(int(bits[1]))
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["cid"], pa.int64()),
             pa.array(out["sig"], pa.binary()), pa.array(out["s1"], pa.int64()), pa.array(out["s2"], pa.int64())],
            names=["doc_id", "n_shingles", "cid", "sig", "s1", "s2"])


NODES = "level int, node long, cid long, s1 long, s2 long, copies long"


def _children(nodes: np.ndarray, rows: np.ndarray, sig: np.ndarray):
    """Child nodes of (node, row) pairs: the coordinates depend on the node
    alone, so documents meet again in a child if they agree on the token."""
    found, first = [], None
    for pick in (1, 2):
        h = mix(nodes + np.uint64(pick) * np.uint64(0x632BE59BD9B4E019))
        coord = (h % np.uint64(WIDTH)).astype(np.int64)
        if first is None:
            first, on = coord, np.ones(len(nodes), bool)
        else:
            on = ((h >> np.uint64(40)) % np.uint64(3) == 0) & (coord != first)
        token = sig[rows, coord].astype(np.uint64) | (coord.astype(np.uint64) << np.uint64(32))
        found.append((mix(mix(nodes + np.uint64(7)) ^ mix(token + np.uint64(13)))[on], rows[on]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _branch(level: int, steps: int):
    """Rows (cid, sig, s1, s2, copies and, below the root, nodes) -> nodes of
    the next ``steps`` levels below ``level``."""
    def run(batches):
        roots = mix(np.arange(1, TREES + 1, dtype=np.uint64))
        for whole in batches:
            for at in range(0, whole.num_rows, 2000):
                batch = whole.slice(at, 2000)
                n = batch.num_rows
                sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(n, WIDTH)
                if not level:
                    rows, nodes = np.repeat(np.arange(n), TREES), np.tile(roots, n)
                else:
                    lists = [np.asarray(x, np.int64).view(np.uint64) for x in batch.column(5).to_pylist()]
                    rows = np.repeat(np.arange(n), [len(x) for x in lists])
                    nodes = np.concatenate(lists)
                for step in range(level + 1, level + steps + 1):
                    nodes, rows = _children(nodes, rows, sig)
                    idx = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(rows), step, np.int32)), pa.array(_long(nodes)),
                         *(batch.column(k).take(idx) for k in (0, 2, 3, 4))],
                        names=["level", "node", "cid", "s1", "s2", "copies"])
    return run


EDGES = "a long, b long, agree int, ca long, cb long"


def _agreement(s: np.ndarray) -> np.ndarray:
    """Agreeing sketch bits of all pairs of a few hundred members."""
    out = np.full((len(s), len(s)), WIDTH, np.int32)
    for k in (0, 1):
        out -= np.bitwise_count(s[:, None, k] ^ s[None, :, k]).astype(np.int32)
    return out


def _alike(s: np.ndarray, starts: np.ndarray, n: int):
    """Pairs (x, y, agree) of members whose sketches agree, of all groups of
    ``n`` members from ``starts``: groups of one size are compared together."""
    i, j = np.triu_indices(n, 1)
    step = max(1, (1 << 20) // len(i)) if n > 1 else len(starts)
    for at in range(0, len(starts), step):
        x, y = (starts[at:at + step, None] + k for k in (i, j))
        agree = np.full(x.shape, WIDTH, np.int32)
        for k in (0, 1):
            agree -= np.bitwise_count(s[x, k] ^ s[y, k]).astype(np.int32)
        ok = agree >= SKETCH_MIN
        yield x[ok], y[ok], agree[ok]


def _near(s: np.ndarray, start: int, n: int):
    """As _alike, of one block: only each member's nearest ones."""
    agree = _agreement(s[start:start + n])
    ok = np.triu(agree >= SKETCH_MIN, 1)
    np.fill_diagonal(agree, -1)
    near = np.zeros_like(ok)
    np.put_along_axis(near, np.argsort(-agree, axis=1, kind="stable")[:, :NEAREST], True, axis=1)
    i, j = np.nonzero(ok & (near | near.T))
    return start + i, start + j, agree[i, j]


def _pairs(batches):
    """Small nodes and blocks: compare all members on their sketches."""
    for batch in batches:
        members, nearest = batch.column(0), np.array(batch.column(1).to_pylist(), bool)
        sizes = members.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        cid, s1, s2, copies = (v.to_numpy(zero_copy_only=False) for v in members.flatten().flatten())
        s = np.stack([s1, s2], axis=1).view(np.uint64)      # bitwise_count takes the absolute value of signed numbers
        found = [_near(s, starts[k], sizes[k]) for k in np.flatnonzero(nearest)]
        for n in np.unique(sizes[~nearest]):
            found.extend(_alike(s, starts[~nearest & (sizes == n)], n))
        if found:
            x, y, agree = (np.concatenate(v) for v in zip(*found, strict=True))
            x, y = np.where(cid[x] < cid[y], x, y), np.where(cid[x] < cid[y], y, x)
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (cid[x], cid[y], agree, copies[x], copies[y])],
                                             names=["a", "b", "agree", "ca", "cb"])


def _agree(x1, x2, y1, y2):
    return (F.lit(WIDTH) - F.bit_count(x1.bitwiseXOR(y1)) - F.bit_count(x2.bitwiseXOR(y2))).cast("int")


def candidates(classes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Distinct candidate pairs (a < b, agree, copies of either) of classes
    (cid, sig, s1, s2, copies), and the members (cell, cid) of the large nodes
    that are dense or at the last level, if there are any.

    The first level holds every class, the later ones only members of large
    nodes: those are taken two at a time, as every pass over them has the same
    shuffles.  A small node of the first of the two then branches too, which
    finds its own pairs again and no others."""
    columns = ["cid", "sig", "s1", "s2", "copies"]
    who = ["cid", "s1", "s2", "copies"]
    # The pivot is the member with the most copies (near copies are closest
    # to the text they were made from), then with the smallest hash over
    # all trees, so the nodes of a cluster mostly agree on it.
    pivot = F.min(F.struct(-F.col("copies"), F.xxhash64("cid"), *who)).alias("p")
    with_pivot = ["level", "node", *who, "n", *(F.col(f"p.{c}").alias(f"p_{c}") for c in who)]
    agree = _agree(F.col("s1"), F.col("s2"), F.col("p_s1"), F.col("p_s2"))
    alone, starred, ended, level = [], [], [], 0
    active = classes.select(columns)
    while level < DEPTH:
        steps = min(2, DEPTH - level) if level else 1
        rows = active.mapInArrow(_branch(level, steps), NODES)
        if not level:
            # Most nodes hold one document and need no pivot: all are counted
            # first, by their name alone.
            sizes = rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1")
            met = cut(rows.join(sizes, "node").select("level", "node", *who, "n"), "shared")
            large = met.where(F.col("n") > SMALL)
            big = cut(large.join(large.groupBy("node").agg(pivot), "node").select(with_pivot), "nodes")
        else:
            rows = cut(rows, "children")
            heads = rows.groupBy("level", "node").agg(F.count("*").alias("n"), pivot).where("n > 1")
            met = cut(rows.join(heads, ["level", "node"]).select(with_pivot), "nodes")
            big = met.where(F.col("n") > SMALL)
        level += steps
        alone.append(met.where(F.col("n") <= SMALL).select(
            "level", "node", F.lit(0).cast("long").alias("block"), F.lit(False).alias("nearest"), *who))
        starred.append(big)
        last = deep = big.where(F.col("level") == level)
        if deep.isEmpty():
            break
        if level < DEPTH:
            dense = cut(deep.groupBy("node").agg(F.avg(agree).alias("agree")).where(F.col("agree") >= DENSE).select("node"), "dense")
            last, deep = (deep.join(dense, "node", how) for how in ("left_semi", "left_anti"))
        alone.append(last.select(
            "level", "node", F.pmod(F.xxhash64("node", "cid"), F.ceil(F.col("n") / BLOCK)).alias("block"),
            F.lit(True).alias("nearest"), *who))
        ended.append(last.select(F.col("p_cid").alias("cell"), "cid"))
        if level == DEPTH or deep.isEmpty():
            break
        nodes = deep.groupBy("cid").agg(F.collect_set("node").alias("nodes"))
        active = may_hold(classes.select(columns), deep.select("cid"), "cid").join(nodes, "cid").select(*columns, "nodes")
    # Small nodes and blocks of all levels are compared in one pass.
    pairs = reduce(DataFrame.union, alone).groupBy("level", "node", "block", "nearest") \
        .agg(F.collect_list(F.struct(*who)).alias("members")).select("members", "nearest").mapInArrow(_pairs, EDGES)
    star = reduce(DataFrame.union, starred).where("cid <> p_cid").select(
        F.least("cid", "p_cid").alias("a"), F.greatest("cid", "p_cid").alias("b"),
        agree.alias("agree"),
        F.when(F.col("cid") < F.col("p_cid"), F.col("copies")).otherwise(F.col("p_copies")).alias("ca"),
        F.when(F.col("cid") < F.col("p_cid"), F.col("p_copies")).otherwise(F.col("copies")).alias("cb")) \
        .where(F.col("agree") >= SKETCH_MIN)
    edges = pairs.union(star).groupBy("a", "b") \
        .agg(F.max("agree").alias("agree"), F.max("ca").alias("ca"), F.max("cb").alias("cb"))
    cells = cut(reduce(DataFrame.union, ended).distinct(), "cells") if ended else None
    return edges, None if cells is None or cells.isEmpty() else cells


def _confirm(batches):
    """(a, b, ta, tb) -> pairs whose full sets reach the threshold."""
    for batch in batches:
        keep, last, s = [], (None, None), None
        for a, ta, tb in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
            if last[0] != a:
                last, s = (a, None), shingles(ta)
            t = shingles(tb)
            both = len(np.intersect1d(s, t, assume_unique=True))
            keep.append(DEN * both >= NUM * (len(s) + len(t) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _words(batches):
    """(cid, text) of the documents whose class is asked for."""
    for batch in batches:
        cids = []
        for text in batch.column(1).to_pylist():
            cids.append(int.from_bytes(hashlib.blake2b(shingles(text).tobytes(), digest_size=8).digest(), "little", signed=True))
        yield pa.RecordBatch.from_arrays([pa.array(cids, pa.int64()), batch.column(1)], names=["cid", "text"])


def may_hold(rows: DataFrame, ids: DataFrame, key: str, most: int = MAP) -> DataFrame:
    """The rows whose ``key`` may be in ``ids`` (key): all that are, and few
    others, so that the join that follows does not shuffle every text.  The ids
    are marked in a map of 16 bits an id, ``most`` bits at most, in pages of
    4 KB; a full map lets more rows pass, none is lost."""
    page = 1 << 15
    size = min(most, page * (16 * ids.count() // page + 1))
    place = F.pmod(F.xxhash64(key), F.lit(size))
    pages = ids.where(F.col(key).isNotNull()).select(place.alias("_h")).groupBy(F.shiftright("_h", 15).alias("_page")) \
        .agg(F.bitmap_construct_agg(F.pmod("_h", F.lit(page))).alias("_map"))
    held = rows.where(F.col(key).isNotNull()).withColumn("_h", place).withColumn("_page", F.shiftright("_h", 15)) \
        .join(F.broadcast(pages), "_page")
    byte = F.conv(F.hex(F.expr(f"substring(_map, CAST(_h % {page} AS INT) DIV 8 + 1, 1)")), 16, 10).cast("int")
    return held.where(F.getbit(byte, F.pmod("_h", F.lit(8)).cast("int")) == 1).select(*rows.columns)


def _with_text(edges: DataFrame, key: str, hot: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``edges`` with the text of ``key``: a key in ``hot`` (key, parts) is
    dealt to its parts, each with its own copy of the text."""
    h = F.xxhash64("a", "b")
    deals = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEAL - 1).cast("long")))
    dealt = edges.withColumn("deal", F.pmod(h, F.lit(DEAL))).join(hot.withColumn("deal", deals), [key, "deal"], "left") \
        .withColumn("part", F.pmod(F.shiftright(h, 8), F.coalesce("parts", F.lit(1)))).drop("deal", "parts")
    copies = texts.select(F.col("cid").alias(key), F.col("text").alias(name)).join(hot, key, "left") \
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))).drop("parts")
    return dealt.join(copies, [key, "part"]).drop("part")


def confirm(edges: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs of ``edges`` (distinct a, b) that reach the threshold; a text
    of many pairs is dealt to parts of about SPLIT pairs."""
    met = edges = cut(edges.select("a", "b"), "pairs")
    # Few texts are hot: stored, they are small enough to be sent to the tasks.
    ends = F.explode(F.array(*(F.struct(F.lit(k).alias("side"), F.col(k).alias("cid")) for k in ("a", "b"))))
    hot = cut(edges.select(ends.alias("e")).groupBy("e.side", "e.cid")
              .agg(F.ceil(F.count("*") / SPLIT).alias("parts")).where("parts > 1"), "hot")
    for key, name in (("a", "ta"), ("b", "tb")):
        own = may_hold(texts, edges.select(F.col(key).alias("cid")), "cid")
        met = _with_text(met, key, hot.where(F.col("side") == key).select(F.col("cid").alias(key), "parts"), own, name)
    return met.select("a", "b", "ta", "tb").mapInArrow(_confirm, "a long, b long")


def _tile(rows: pa.Table) -> pa.Table:
    """One tile: links of its open members (``probe``) to members of other
    components, one link per component, counted on the full sets."""
    cid, comp = (np.array(rows.column(k).to_pylist(), np.int64) for k in ("cid", "component"))
    probe = np.array(rows.column("probe").to_pylist(), bool)
    sets = [shingles(t) for t in rows.column("text").to_pylist()]
    y = np.flatnonzero(~probe)
    sizes = np.array([len(sets[i]) for i in y], np.int64)
    tokens = np.concatenate([sets[i] for i in y]) if len(y) else np.zeros(0, np.uint64)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], np.repeat(np.arange(len(y)), sizes)[order]
    a, b = [], []
    for x in np.flatnonzero(probe):
        lo, hi = (np.searchsorted(tokens, sets[x], side) for side in ("left", "right"))
        n = hi - lo
        at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
        both = np.bincount(owner[at], minlength=len(y))
        ok = np.flatnonzero((DEN * both >= NUM * (len(sets[x]) + sizes - both)) & (comp[y] != comp[x]))
        first = ok[np.unique(comp[y[ok]], return_index=True)[1]]
        a.append(np.full(len(first), cid[x]))
        b.append(cid[y[first]])
    a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
    return pa.table([pa.array(np.minimum(a, b), pa.int64()), pa.array(np.maximum(a, b), pa.int64())], names=["a", "b"])


def tiles(members: DataFrame) -> DataFrame:
    """Members (cell, cid, component, n_shingles) -> (cell, xt, yt, probe, cid,
    component): every member that is outside its cell's main component as a
    probe against all members, both dealt to tiles; cells of one component
    have none."""
    parts = members.groupBy("cell", "component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    top = F.max(F.struct("n", "component", "w"))
    plan = parts.groupBy("cell").agg(top.alias("top"), F.sum("w").alias("w"), F.count("*").alias("k")).where("k > 1") \
        .select("cell", F.col("top.component").alias("main"), F.ceil(F.col("w") / TILE).alias("ys"),
                F.ceil((F.col("w") - F.col("top.w")) / TILE).alias("xs"))
    # A cell may hold a large share of all rows: it meets its plan in parts.
    plan = plan.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEAL - 1).cast("long"))))
    h = F.xxhash64("cid", "cell")
    own_x, own_y = F.pmod(h, F.col("xs")), F.pmod(F.shiftright(h, 20), F.col("ys"))
    zero = F.lit(0).cast("long")
    as_member = F.transform(F.sequence(zero, F.col("xs") - 1), lambda k: F.struct(
        k.alias("xt"), own_y.alias("yt"), F.lit(False).alias("probe")))
    as_probe = F.transform(F.sequence(zero, F.col("ys") - 1), lambda k: F.struct(
        own_x.alias("xt"), k.alias("yt"), F.lit(True).alias("probe")))
    return members.withColumn("deal", F.pmod(F.xxhash64("cid"), F.lit(DEAL))).join(plan, ["cell", "deal"]) \
        .select("cell", "cid", "component", F.explode(F.when(
            F.col("component") == F.col("main"), as_member).otherwise(F.concat(as_member, as_probe))).alias("t")) \
        .select("cell", "t.xt", "t.yt", "t.probe", "cid", "component")


def finish(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) between components that share a cell."""
    dealt = cut(tiles(members), "tiles")
    return dealt.join(may_hold(texts, dealt.select("cid").distinct(), "cid").select("cid", "text"), "cid") \
        .select("cell", "xt", "yt", "probe", "cid", "component", "text") \
        .groupBy("cell", "xt", "yt").applyInArrow(_tile, "a long, b long").distinct()


def _regroup(label: DataFrame, merged: DataFrame) -> DataFrame:
    """``label`` with its components replaced by what they were merged into
    (node, component)."""
    into = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    return label.join(into, "component", "left").withColumn("component", F.coalesce("into", "component")).drop("into")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    sets = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
               .mapInArrow(_sketch, SETS), "sets")
    named = sets.where("cid IS NOT NULL AND doc_id IS NOT NULL")
    # Rows of one class have one set, so the same values of it.
    same = [F.any_value(c).alias(c) for c in ("n_shingles", "sig", "s1", "s2")]
    classes = cut(named.groupBy("cid").agg(F.min("doc_id").alias("doc_id"), *same, F.count("*").alias("copies")), "classes")
    edges, cells = candidates(classes)
    edges = cut(edges, "edges")
    # Texts of the classes that have a candidate or are in a large node.
    asked = edges.select(F.col("a").alias("cid")).union(edges.select("b"))
    asked = (asked if cells is None else asked.union(cells.select("cid"))).distinct()
    asked = cut(asked.join(classes.select("cid", "doc_id"), "cid"), "asked")
    texts = may_hold(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                     .where("text IS NOT NULL"), asked, "doc_id").select("doc_id", "text") \
        .mapInArrow(_words, "cid long, text string").dropDuplicates(["cid"]).join(asked.select("cid"), "cid")
    texts = cut(texts, "texts")
    # First each class's pair with its most copied neighbour: those links join
    # most of every group.  Then all pairs that still cross groups.
    both = edges.select("a", "b", F.col("cb").alias("copies")).union(edges.select("b", "a", "ca"))
    first = both.groupBy("a").agg(F.min(F.struct(-F.col("copies"), F.xxhash64("b"), "b")).alias("m")) \
        .select(F.least("a", "m.b").alias("a"), F.greatest("a", "m.b").alias("b")).distinct()
    links = cut(confirm(first, texts), "links")
    group = cut(components(links), "groups")
    ga = group.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    gb = group.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    rest = edges.select("a", "b").join(first.select("a", "b"), ["a", "b"], "left_anti") \
        .join(ga, "a", "left").join(gb, "b", "left") \
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    crossing = cut(confirm(rest, texts), "links")
    # A doc_id with several sets links their classes.  From here on a group
    # stands for its members, so that only what crosses groups is followed.
    several = named.groupBy("doc_id").agg(F.min("cid").alias("b"), F.max("cid").alias("hi")).where("b <> hi")
    own = named.join(several, "doc_id").select(F.col("cid").alias("a"), "b")
    merged = components(crossing.union(own).join(ga, "a", "left").join(gb, "b", "left")
                        .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    label = classes.select("cid", "n_shingles", F.col("doc_id").alias("rep")) \
        .join(group.withColumnRenamed("node", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    label = cut(_regroup(label, merged), "labels")
    if cells is not None:
        # The groups as those links leave them, then what they leave open.
        members = cut(cells.join(label.drop("rep"), "cid").select("cell", "cid", "component", "n_shingles"), "members")
        late = cut(finish(members, texts), "links")
        if not late.isEmpty():
            la, lb = (label.select(F.col("cid").alias(k), F.col("component").alias(f"c{k}")) for k in ("a", "b"))
            merged = components(late.join(la, "a").join(lb, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
            label = _regroup(label, merged)
    # From classes to documents: the smallest doc_id of its classes names a group.
    least = label.groupBy("component").agg(F.min("rep").alias("component_id"))
    found = label.join(least, "component").select("cid", "component_id")
    doc = named.join(found, "cid").groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sets.select("doc_id", "n_shingles").join(doc, "doc_id", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
