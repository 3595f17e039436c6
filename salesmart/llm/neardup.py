"""Near-duplicates by a chosen-path set similarity join, then exact links.

A document is the set of its distinct word shingles.  Equal sets are one
class, settled by a group-by; the join runs over classes, each with a key of
its own, so that neither NULL nor repeated ids can join or part them.

*Trees.*  Each set has SIGNATURE minwise tokens.  Every tree branches the
representatives by a chosen token (those with an equal token meet in a node);
a node of more than NODE members is branched again by BRANCHES tokens chosen
by its path, down to DEPTH levels.  Small nodes are compared exhaustively on
8-bit sketches of the tokens; a node that is still larger is dealt in blocks
(see large_edges).  Two sets of similarity 0.8 miss each other in one
tree with probability 0.2 (0.26 if their nodes are branched to the last
level), so TREES independent trees leave a pair out with probability below
1e-9, and the sketch comparison (more than four standard deviations below the
threshold) below 2e-5.

*Links.*  A node yields a spanning forest of its sketch links, never all its
pairs.  The forests' components are candidate clusters: every link that any
tree has found lies inside one.  Each representative's full set goes once to
its cluster, where links are confirmed exactly; clusters too large for one
task are dealt in blocks.  Confirmed links, again as forests, are joined to
components.

*Large groups.*  Every block of a large group meets the same pivots, members
chosen by their hash, which is linear in the group and joins a group of near
copies at once.  Members outside the group's largest part then meet all its
members, block by block: no link is lost, and the work beyond the linear part
is that of the members that are not copies of most others.

Texts without words have an empty set and no link.  NULL ids are never the
smallest of a component; a component of NULL ids only has a NULL id.  An
empty table gives no row.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from salesmart.llm.common import Words, by_slice, gram_hashes, id_filter, mix, release, settle, slices, split_by_ids, temporary, texts

#: Words of a shingle in the report and in a pipeline's stage; similarity as a ratio of integers.
SHINGLE, STAGE_SHINGLE, ABOVE, BELOW = 4, 5, 80, 100
#: Minwise tokens of a set, trees, levels of branching below the first, tokens branched by at each.
SIGNATURE, TREES, DEPTH, BRANCHES = 128, 16, 3, 2
#: Members of a node that are compared exhaustively.
NODE = 2000
#: Equal sketches from which two members may be linked.
SKETCH = 0.65
#: Bytes of full sets that one task compares.
CLUSTER_BYTES = 16 << 20

_rng = np.random.default_rng(20251)
_FACTORS = _rng.integers(0, 2**63, SIGNATURE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its shingles (all words as one where there are fewer)."""
    words = Words(column, lower=True)
    grams = gram_hashes(words.hash, size)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= size:
            out.append(np.unique(grams[a : b - size + 1]))
        elif b > a:
            out.append(gram_hashes(words.hash[a:b], b - a, seed=b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(tokens: np.ndarray) -> np.ndarray:
    """Minwise tokens of a set, 32 bits each."""
    low = np.full(SIGNATURE, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(tokens), 2048):
        part = tokens[None, at : at + 2048] * _FACTORS[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return (mix(low) >> np.uint64(32)).astype("<u4")


def fingerprint(tokens: np.ndarray) -> bytes | None:
    return blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def sets(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, print`` (128 bits of the set), ``sig`` and ``sketch`` (a byte of each token); empty sets have none."""
    docs = texts(docs)

    def run(part):
        found = shingle_sets(part.column("text"), size)
        prints = [fingerprint(s) for s in found]
        # equal sets of one slice share a signature
        known: dict[bytes, tuple[bytes, bytes]] = {}
        for p, s in zip(prints, found):
            if p is not None and p not in known:
                sig = signature(s)
                known[p] = sig.tobytes(), sig.astype("u1").tobytes()
        both = [known.get(p, (None, None)) for p in prints]
        return pa.RecordBatch.from_arrays(
            [part.column("doc_id"), pa.array([len(s) for s in found], pa.int64()), pa.array(prints, pa.binary()), *(pa.array([b[k] for b in both], pa.binary()) for k in (0, 1))],
            ["doc_id", "n_shingles", "print", "sig", "sketch"],
        )

    return by_slice(docs, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, print binary, sig binary, sketch binary")


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(len(column), SIGNATURE)


def _first_nodes(reps: DataFrame) -> DataFrame:
    """``node, rep``: one node per tree, by the tree's own token."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _signatures(batch.column("sig"))[:, :TREES].astype(np.uint64)
            node = mix(sig + (np.arange(1, TREES + 1).astype(np.uint64) << np.uint64(40)))
            rep = batch.column("rep").take(pa.array(np.repeat(np.arange(len(sig)), TREES)))
            yield pa.RecordBatch.from_arrays([pa.array(node.ravel().view(np.int64)), rep], ["node", "rep"])

    return reps.select("rep", "sig").mapInArrow(run, f"node long, rep {reps.schema['rep'].dataType.simpleString()}")


def _branches(rows: DataFrame) -> DataFrame:
    """Children of ``node, rep, sig``: BRANCHES tokens chosen by the node."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            node = batch.column("node").to_numpy().view(np.uint64)
            sig = _signatures(batch.column("sig"))
            out = []
            for k in range(BRANCHES):
                path = mix(node + np.uint64(0x9E3779B97F4A7C15 * (k + 1) & 0xFFFFFFFFFFFFFFFF))
                token = sig[np.arange(len(node)), TREES + (path % np.uint64(SIGNATURE - TREES)).astype(np.int64)]
                out.append(mix(path ^ mix(token.astype(np.uint64) + np.uint64(k))))
            rep = batch.column("rep").take(pa.array(np.tile(np.arange(len(node)), BRANCHES)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out).view(np.int64)), rep], ["node", "rep"])

    return rows.mapInArrow(run, f"node long, rep {rows.schema['rep'].dataType.simpleString()}")


def _shared(rows: DataFrame) -> DataFrame:
    """``rows`` of nodes with two members or more, with their number ``n``."""
    counts = rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return settle(rows.join(counts, "node"), "neardup-nodes")


def leaves(reps: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``node, rep``: members of the nodes that one task compares, and of larger ones (None if there is none)."""
    rows = _shared(_first_nodes(reps))
    small = rows.where(F.col("n") <= NODE).select("node", "rep")
    large = rows.where(F.col("n") > NODE)
    for _ in range(DEPTH):
        if large.isEmpty():
            return small, None
        rows = _shared(_branches(large.join(reps.select("rep", "sig"), "rep").select("node", "rep", "sig")))
        small = small.unionByName(rows.where(F.col("n") <= NODE).select("node", "rep"))
        large = rows.where(F.col("n") > NODE)
    return small, None if large.isEmpty() else large.select("node", "rep")


class Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, members: np.ndarray) -> None:
        """All roots of ``members`` become the smallest of them."""
        roots = np.unique(self.root[members])
        if len(roots) > 1:
            self.root[np.isin(self.root, roots[1:])] = roots[0]

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        inner = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.root[inner], inner


def sketch_forest(sketches: np.ndarray) -> Forest:
    """Components of the sketch links among some members."""
    forest = Forest(len(sketches))
    for k in range(len(sketches) - 1):
        others = k + 1 + np.flatnonzero(forest.root[k + 1 :] != forest.root[k])
        if len(others):
            near = others[(sketches[others] == sketches[k]).sum(axis=1) >= SKETCH * SIGNATURE]
            if len(near):
                forest.join(np.append(near, k))
    return forest


def exact_forest(sets_: list[np.ndarray]) -> Forest:
    """Components of the exact links among some sets."""
    forest = Forest(len(sets_))
    size = np.array([len(s) for s in sets_])
    first = np.concatenate(([0], np.cumsum(size)))
    tokens, code = np.unique(np.concatenate(sets_), return_inverse=True)
    mark = np.zeros(len(tokens), bool)
    for k in range(len(sets_) - 1):
        others = k + 1 + np.flatnonzero(forest.root[k + 1 :] != forest.root[k])
        # a link needs 80 % of the larger size
        others = others[(BELOW * np.minimum(size[others], size[k]) >= ABOVE * np.maximum(size[others], size[k]))]
        if not len(others):
            continue
        mine = code[first[k] : first[k + 1]]
        mark[mine] = True
        if len(others) * 8 < len(sets_) - k:
            both = np.array([mark[code[first[o] : first[o + 1]]].sum() for o in others])
        else:
            ahead = np.concatenate(([0], np.cumsum(mark[code[first[k + 1] :]])))
            both = ahead[first[others + 1] - first[k + 1]] - ahead[first[others] - first[k + 1]]
        mark[mine] = False
        linked = others[BELOW * both >= ABOVE * (size[others] + size[k] - both)]
        if len(linked):
            forest.join(np.append(linked, k))
    return forest


def _forest_edges(rows: DataFrame, key: str, value: str, compare) -> DataFrame:
    """``u, v`` of a spanning forest of each ``key``; one key's members are held at a time."""
    kind = rows.schema["rep"].dataType.simpleString()
    rows = rows.repartition(key).sortWithinPartitions(key, "rep")

    def run(batches):
        reps, values, open_, kind_ = [], [], None, None

        def done():
            if len(reps) < 2:
                return None
            u, v = compare(values).edges()
            if not len(u):
                return None
            held = pa.array(reps, kind_)
            return pa.RecordBatch.from_arrays([held.take(pa.array(u)), held.take(pa.array(v))], ["u", "v"])

        for batch in batches:
            kind_ = batch.column("rep").type
            keys, rep_list, value_list = batch.column(key).to_pylist(), batch.column("rep").to_pylist(), batch.column(value).to_pylist()
            for k, r, x in zip(keys, rep_list, value_list):
                if k != open_:
                    if open_ is not None and (out := done()) is not None:
                        yield out
                    reps, values, open_ = [], [], k
                elif reps and reps[-1] == r:  # sent by several tasks
                    continue
                reps.append(r)
                values.append(x)
        if open_ is not None and (out := done()) is not None:
            yield out

    return rows.mapInArrow(run, f"u {kind}, v {kind}")


def large_edges(rows: DataFrame, key: str, value: str, weight, bound: int, compare) -> DataFrame:
    """As ``_forest_edges``, for keys whose members weigh more than ``bound``, what one task compares.

    Each key is dealt in blocks of half the bound.  First every block is
    compared together with the key's pivots, about half the bound chosen by
    hash.  Then the members outside the key's largest part, in blocks too,
    meet all its members.  A key's links are those of comparing all its pairs.
    """
    half = max(bound // 2, 1)
    rows = rows.select(F.col(key).alias("key"), "rep", F.col(value).alias("value"), weight.cast("long").alias("w")).distinct()
    total = rows.groupBy("key").agg(F.ceil(F.sum("w") / half).alias("blocks"))
    dealt = rows.join(total, "key").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(7)), "blocks"))
    dealt = settle(dealt, "neardup-dealt")

    def forest(parts: DataFrame) -> DataFrame:
        parts = parts.select(F.xxhash64("key", "block", "other").alias("key"), "rep", "value")
        return settle(_forest_edges(parts, "key", "value", compare), "neardup-forest")

    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pivots = dealt.where(F.pmod(F.xxhash64("rep", F.lit(11)), "blocks") == 0).select("key", "rep", "value", every.alias("block"))
    none = F.lit(-1).cast("long").alias("other")
    first = forest(dealt.select("key", "rep", "value", "block").unionByName(pivots).select("*", none))
    part = components(first).withColumnRenamed("node", "rep")
    labelled = dealt.select("key", "rep", "w").join(part, "rep", "left").select("key", "rep", "w", F.coalesce("component", "rep").alias("part"))
    main = labelled.groupBy("key", "part").agg(F.sum("w").alias("w")).groupBy("key").agg(F.max(F.struct("w", "part")).alias("main"))
    rest = settle(labelled.join(main, "key").where(F.col("part") != F.col("main.part")).select("key", "rep", "w"), "neardup-rest")
    if rest.isEmpty():
        return first
    others = rest.groupBy("key").agg(F.ceil(F.sum("w") / half).alias("others"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("others") - 1))
    all_rows = dealt.join(others, "key").select("key", "rep", "value", "block", each.alias("other"))
    own = dealt.join(rest.select("key", "rep"), ["key", "rep"]).join(others, "key")
    own = own.select("key", "rep", "value", every.alias("block"), F.pmod(F.xxhash64("rep", F.lit(13)), "others").alias("other"))
    return first.unionByName(forest(all_rows.unionByName(own)))


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest reachable node) for every node of ``u, v``.

    Randomised contraction: each node moves to the one of its neighbours, or
    itself, whose hash of this round is smallest, and takes its edges along,
    until no edge is left.  Whatever the graph and the names, at most three
    quarters of the nodes are expected to be left after a round, so their
    number is logarithmic.  Minima are combined before they are shuffled, and
    a node's many edges are an ordinary skewed join.  The rounds' moves, each
    table smaller than the one before, are put together from the last back.
    """
    edges = settle(edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u <> v").distinct(), "neardup-edges")
    rounds: list[DataFrame] = []
    while not rounds or not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("to")), F.struct(F.col("v").alias("node"), F.col("u").alias("to")))).alias("e"))
        rank = lambda name: F.struct(F.xxhash64(F.col(name), F.lit(len(rounds))).alias("hash"), F.col(name).alias("to"))  # noqa: B023, E731
        moves = ends.select("e.node", "e.to").groupBy("node").agg(F.min(rank("to")).alias("least"))
        moves = settle(moves.select("node", F.least("least", rank("node"))["to"].alias("to")), "neardup-moves")
        rounds.append(moves)
        a, b = (moves.select(F.col("node").alias(x), F.col("to").alias(f"to_{x}")) for x in "uv")
        edges = edges.join(a, "u").join(b, "v").select(F.least("to_u", "to_v").alias("u"), F.greatest("to_u", "to_v").alias("v"))
        edges = settle(edges.where("u <> v").distinct(), "neardup-edges")
    found = rounds.pop().withColumnRenamed("to", "root")
    for moves in reversed(rounds):
        later = found.withColumnRenamed("node", "to")
        found = settle(moves.join(later, "to", "left").select("node", F.coalesce("root", "to").alias("root")), "neardup-roots")
    return found.join(found.groupBy("root").agg(F.min("node").alias("component")), "root").select("node", "component")


def cluster_sets(docs: DataFrame, clusters: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``cluster, rep, tokens``: the full sets of the classes in ``clusters`` (``cluster, rep, print`` and a member's ``id``).

    Documents in no cluster are not moved: the join is behind a filter of the
    members' hashed ids.  A task sends each set once.
    """
    member = id_filter(clusters.select("id"))

    def run(batches):
        sent = set()
        for batch in batches:
            for part in slices([batch.filter(pa.array(member(batch.column("doc_id"))))]):
                found = {}
                for tokens in shingle_sets(part.column("text"), size):
                    mark = fingerprint(tokens)
                    if mark is not None and mark not in sent:
                        sent.add(mark)
                        found[mark] = tokens.tobytes()
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["print", "tokens"])
        release()

    return texts(docs).mapInArrow(run, "print binary, tokens binary").join(clusters.select("print", "cluster", "rep"), "print").select("cluster", "rep", "tokens")


def grouped(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, print, component_id, first`` of every document; ``first`` is the print of the component's class that stays."""
    all_sets = settle(sets(docs, size), "neardup-sets")
    classes = all_sets.where("print IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("id"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n"))
    # the keys are fixed by being written
    classes = settle(classes.withColumn("rep", F.monotonically_increasing_id()), "neardup-classes")
    reps = classes.select("rep", "sig", "sketch", "n")
    small, large = leaves(reps)
    sketches = reps.select("rep", "sketch")

    def by_sketch(values):
        return sketch_forest(np.frombuffer(b"".join(values), np.uint8).reshape(len(values), SIGNATURE))

    edges = _forest_edges(small.join(sketches, "rep"), "node", "sketch", by_sketch)
    if large is not None:
        edges = edges.unionByName(large_edges(large.join(sketches, "rep"), "node", "sketch", F.lit(1), NODE, by_sketch))
    candidates = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("cluster"))
    candidates = settle(candidates.join(classes.select("rep", "id", "print", "n"), "rep"), "neardup-candidates")
    weight = candidates.groupBy("cluster").agg(F.sum(F.col("n") * 8).alias("bytes"))
    split = settle(weight.where(F.col("bytes") > CLUSTER_BYTES).select("cluster"), "neardup-large")

    def by_set(values):
        return exact_forest([np.frombuffer(v, np.uint64) for v in values])

    edges = _forest_edges(cluster_sets(docs, candidates.join(split, "cluster", "left_anti"), size), "cluster", "tokens", by_set)
    if not split.isEmpty():
        hot = cluster_sets(docs, candidates.join(split, "cluster", "left_semi"), size)
        edges = edges.unionByName(large_edges(hot, "cluster", "tokens", F.length("tokens"), CLUSTER_BYTES, by_set))
    linked = components(edges).withColumnRenamed("node", "rep").join(candidates.select("rep", "id", "print"), "rep")
    # the smallest id stays, NULL last; of its texts the one of the smallest print
    best = linked.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "print")).alias("best"))
    linked = linked.join(best, "component").select("print", F.lit(True).alias("linked"), F.col("best.id").alias("best_id"), F.col("best.print").alias("best_print"))
    classes = classes.select("print", "id").join(linked, "print", "left")
    classes = classes.select("print", F.when(F.col("linked"), F.col("best_id")).otherwise(F.col("id")).alias("component_id"), F.coalesce("best_print", "print").alias("first"))
    out = all_sets.select("doc_id", "n_shingles", "print").join(classes, "print", "left")
    component = F.when(F.col("print").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", "print", component.alias("component_id"), "first")


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document, by shingles of ``size`` words."""
    with temporary(docs.sparkSession):
        found = grouped(docs, size).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
        return settle(found, "neardup", keep=True)


def deduplicate(docs: DataFrame, size: int = STAGE_SHINGLE) -> DataFrame:
    """One row of ``docs`` for each group of near-duplicates by shingles of ``size`` words, all columns unchanged.

    Rows of one id, or without one, are a group only if their texts are; texts
    without words if they are equal and of one id.  Only rows of documents that
    go, or whose id is repeated, are moved.
    """
    stays = F.col("print").isNull() | (F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("print") == F.col("first")))
    with temporary(docs.sparkSession):
        found = settle(grouped(docs, size).select("doc_id", "print", stays.alias("kept")), "neardup-kept", keep=True)
    special = found.groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count(F.lit(1)).alias("n")).where("NOT kept OR n > 1")
    clear, near = split_by_ids(docs, special.select("doc_id"))

    def marked(batches):
        for part in slices(batches):
            column = part.column(part.schema.get_field_index("text"))
            prints = [fingerprint(s) for s in shingle_sets(column.cast(pa.string()), size)]
            # texts without words: NULL, or the text itself
            keys = [p if p is not None else b"" if t is None else b"t" + t.encode() for p, t in zip(prints, column.to_pylist())]
            fields = [*part.schema.names, "_print", "_key"]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(prints, pa.binary()), pa.array(keys, pa.binary())], fields)
        release()

    near = near.mapInArrow(marked, StructType([*docs.schema.fields, StructField("_print", BinaryType()), StructField("_key", BinaryType())]))
    gone = found.where("NOT kept").select(F.col("doc_id").alias("_id"), F.col("print").alias("_gone")).distinct()
    near = near.join(gone, (F.col("_print") == F.col("_gone")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti")
    return clear.unionByName(near.dropDuplicates(["doc_id", "_key"]).select(docs.columns))
