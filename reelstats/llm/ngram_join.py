"""N-gram Jaccard self-join by T-occurrence search (operator 5).

A text's set: A-Z lower-cased, words `[^\\x20\\x09-\\x0D]+`, distinct 5-word
shingles (fewer words: the whole sequence as one; none: empty, linked with
nothing). Two sets link when 100 * |intersection| >= 80 * |union|, that is when
their overlap reaches T = ceil(4 (|a| + |b|) / 9).

1. Classes. Documents with equal sets are one class (64-bit set signature).
2. Candidates. All shingles of all documents are counted in a fixed-size table
   of counters, which orders shingles from rare to frequent. By that order two
   sets that link share at least l of the first n - ceil(0.8 n) + l shingles of
   each, for any l; here l = 1 + n // 20, of the smaller set. These prefixes
   travel as packed arrays, one row per task and shard, and one per class in a
   task. Classes that share a prefix shingle are a block; a class that shares
   fewer than l of its prefix shingles with any others links with nothing.
3. Homes. A class's home is the largest block around it, so that a group of near
   copies gets one home. A home is dealt to pieces of bounded size. Candidates of
   one home are searched inside each piece and against the home's first piece:
   work linear in the pieces. Candidates with different homes are listed as pairs,
   by joining a block with those of its classes that lie outside its main home.
4. Rest. Components of the links found so far are computed; pairs of further
   pieces of a home are searched unless all their classes are in one component
   already. Links inside a known component may be left out, no others, so the
   components are exact.
5. T-occurrence search (DivideSkip). For a query set, of the inverted lists of
   its shingles the L longest are set aside, the short ones are merged and
   counted, candidates with T - L or more are binary-probed in the long lists,
   and those reaching T are links. A query's candidates are dealt to groups of
   bounded size.

Defined cases: null texts are empty; rows with a null doc_id rank before all
ids; rows that repeat a doc_id are judged by their own texts; an empty table
gives an empty result; extra columns are ignored by `components` and kept by
`one_per_group`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstats.llm import arrowtext as at
from reelstats.llm import rarity
from reelstats.llm.components import connected_components
from reelstats.llm.tables import NULL_ID, id_key, shards_for, written

WORDS = 5
GROUP_SHINGLES = 500_000  # shingles of the candidates in one group of a query, or of one piece of a home
LARGE_BLOCK = 8
BLOCK_PIECE = 1_000  # classes of one block that a task of its join reads, next to those outside the block's main home


def need(n):
    """Least overlap of a set of n with any set it links with: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def overlap(a, b):
    """Least overlap of linked sets of sizes a and b: ceil(4 (a + b) / 9)."""
    return (4 * (a + b) + 8) // 9


def extra(n):
    """Prefix shingles that a set of n shares at least, with a set no smaller."""
    return 1 + n // 20


def shingle_sets(arr: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text."""
    buf, off = at.utf8(arr)
    buf = at.lower_ascii(buf)
    start, end, counts = at.words(buf, off)
    h = at.span_hash(buf, start, end)
    gram = at.ngram_hash(h, WORDS)
    first = np.cumsum(counts) - counts
    out = []
    for a, n in zip(first.tolist(), counts.tolist()):
        if n >= WORDS:
            out.append(np.unique(gram[a : a + n - WORDS + 1]))
        elif n:
            whole = at.U64(n)
            for x in h[a : a + n]:
                whole = at.mix(np.array([whole ^ x], at.U64))[0] + at.U64(n)
            out.append(np.array([whole], at.U64))
        else:
            out.append(np.zeros(0, at.U64))
    return out


def _signature(s: np.ndarray) -> int:
    total = np.add.reduce(at.mix(s + at.U64(len(s))), dtype=at.U64)
    return int(at.mix(np.array([total ^ at.U64(len(s))], at.U64)).view(np.int64)[0])


def profile(docs: DataFrame) -> DataFrame:
    """Per document (kind 0): id, n, sig; per task and segment (kind 1): shingle counters. Written once."""
    names = ["kind", "id", "n", "sig", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(rarity.COUNTERS, np.uint32)
        for batch in batches:
            for part in at.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"))
                rarity.count(table, np.concatenate(sets))
                n = len(sets)
                yield pa.record_batch([
                    pa.array(np.zeros(n, np.int32)), part.column("_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_signature(s) for s in sets], pa.int64()), pa.nulls(n, pa.binary()),
                ], names=names)
        if table.any():
            n = rarity.SEGMENTS
            yield pa.record_batch([
                pa.array(np.ones(n, np.int32)), pa.array(range(n), pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                pa.array(rarity.packed(table), pa.binary()),
            ], names=names)

    rows = docs.select(id_key().cast("long").alias("_id"), "text").mapInArrow(run, "kind int, id long, n long, sig long, counts binary")
    return written(rows, "shingle-profile")


def blocks(docs: DataFrame, freq, shards: int) -> DataFrame:
    """(code, sig, n, members): the classes of every block of two or more, with its size."""

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        code, sig, size = [np.zeros(0, at.U64)], [], []
        for batch in batches:
            for part in at.chunks(batch, "text"):
                for s in shingle_sets(part.column("text")):
                    if not len(s) or (k := _signature(s)) in seen:
                        continue
                    seen.add(k)
                    p = min(len(s) - need(len(s)) + extra(len(s)), len(s))
                    c = rarity.codes(s, freq.value)
                    code.append(np.partition(c, p - 1)[:p] if p < len(c) else c)
                    sig.append(k)
                    size.append(len(s))
        lens = np.array([len(c) for c in code[1:]], np.int64)
        code = np.concatenate(code)
        sig, size = np.repeat(np.array(sig, np.int64), lens), np.repeat(np.array(size, np.int32), lens)
        shard = (at.mix(code) % at.U64(shards)).astype(np.int64)
        order = np.argsort(shard, kind="stable")
        cut = np.searchsorted(shard[order], np.arange(shards + 1))
        for i in range(shards):
            own = order[cut[i] : cut[i + 1]]
            if len(own):
                yield pa.record_batch([pa.array([i], pa.int32()), *(pa.array([x[own].tobytes()], pa.binary()) for x in (code, sig, size))], names=["shard", "code", "sig", "n"])

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for c, s, n in zip(batch.column("code"), batch.column("sig"), batch.column("n")):
                parts.append((np.frombuffer(c.as_py(), at.U64), np.frombuffer(s.as_py(), np.int64), np.frombuffer(n.as_py(), np.int32)))
        code, sig, n = (np.concatenate(x) for x in zip(*parts))
        parts.clear()
        order = np.argsort(code, kind="stable")
        code, sig, n = code[order], sig[order], n[order]
        # only codes met twice are sorted further
        same = np.concatenate([[False], code[1:] == code[:-1], [False]])
        again = same[1:] | same[:-1]
        code, sig, n = code[again], sig[again], n[again]
        order = np.lexsort((sig, n, code))
        code, sig, n = code[order], sig[order], n[order]
        fresh = np.ones(len(code), bool)
        fresh[1:] = (code[1:] != code[:-1]) | (sig[1:] != sig[:-1])
        code, sig, n = code[fresh], sig[fresh], n[fresh]
        begin = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        size = np.diff(np.concatenate([begin, [len(code)]]))
        members = np.repeat(size, size)
        keep = np.flatnonzero(members > 1)
        for a in range(0, len(keep), 100_000):
            i = keep[a : a + 100_000]
            yield pa.record_batch([
                pa.array(code[i].view(np.int64)), pa.array(sig[i]), pa.array(n[i].astype(np.int64)), pa.array(members[i]),
            ], names=["code", "sig", "n", "members"])

    packed = docs.select("text").mapInArrow(post, "shard int, code binary, sig binary, n binary")
    return packed.groupBy("shard").applyInArrow(meet, "code long, sig long, n long, members long")


class ListIndex:
    """Inverted lists of a few sets, searched for the sets that link with a query set."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        flat = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.token, self.begin = np.unique(flat[order], return_index=True)
        self.length = np.diff(np.append(self.begin, len(flat)))

    def search(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, overlap) of the linked sets, by DivideSkip."""
        t = overlap(len(query), self.size)
        at_ = np.minimum(np.searchsorted(self.token, query), len(self.token) - 1)
        lists = at_[self.token[at_] == query]
        if not len(lists):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        lists = lists[np.argsort(self.length[lists], kind="stable")]
        longest = int(self.length[lists[-1]])
        n_long = int(min(len(lists), max(0, t.min()) / (0.5 * np.log2(max(longest, 2)) + 1)))
        short, long_ = lists[: len(lists) - n_long], lists[len(lists) - n_long :]
        # merge the short lists and count
        count = np.bincount(self.owner[at.flat(self.begin[short], self.length[short])], minlength=len(self.size))
        alive = np.flatnonzero(count >= np.maximum(t - n_long, 0))
        # binary-probe the long ones, dropping what can no longer reach its threshold
        for k, b in enumerate(long_[::-1].tolist()):
            if not len(alive):
                break
            own = self.owner[self.begin[b] : self.begin[b] + self.length[b]]
            p = np.minimum(np.searchsorted(own, alive), len(own) - 1)
            count[alive] += own[p] == alive
            alive = alive[count[alive] + (n_long - k - 1) >= t[alive]]
        alive = alive[count[alive] >= t[alive]]
        return alive, count[alive]


def _prune(members: DataFrame) -> DataFrame:
    """The blocks without classes that share too few prefix shingles to link with any other."""
    enough = members.groupBy("sig", "n").agg(F.count(F.lit(1)).alias("_c")).where(F.col("_c") >= 1 + F.expr("((4 * n + 4) div 5) div 20")).select("sig")
    left = members.drop("members").join(enough, "sig")
    return left.join(left.groupBy("code").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "code")


def _homes(members: DataFrame) -> DataFrame:
    """sig, n, home: a class's largest block, or a larger home of the classes it shares blocks with.

    Any labels give right results; these keep a group of near copies together.
    """
    home = members.groupBy("sig", "n").agg(F.max(F.struct("members", "code")).alias("_h"))
    large = members.where(F.col("members") >= LARGE_BLOCK).select("code", "sig", "n")
    for _ in range(2):
        of_block = large.join(home, ["sig", "n"]).groupBy("code").agg(F.max("_h").alias("_h"))
        reached = large.join(of_block, "code").groupBy("sig", "n").agg(F.max("_h").alias("_h"))
        home = home.unionByName(reached).groupBy("sig", "n").agg(F.max("_h").alias("_h"))
    return home.select("sig", "n", F.col("_h.code").alias("home"))


def _pieces(homes: DataFrame) -> DataFrame:
    """homes plus the piece of each class; homes of a single class are left out."""
    size = homes.groupBy("home").agg(F.sum("n").alias("_n"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    size = size.select("home", F.ceil(F.col("_n") / GROUP_SHINGLES).cast("int").alias("_pieces"))
    return homes.join(size, "home").withColumn("piece", F.pmod(F.xxhash64("sig"), F.col("_pieces")).cast("int")).drop("_pieces")


def _across(members: DataFrame, homes: DataFrame) -> DataFrame:
    """u, v, vn: pairs of one block, of sizes that may link, with different homes; un <= vn.

    Of two classes with different homes one lies outside the block's most
    frequent home. So only those outside are joined with the block, which is
    dealt to pieces; its number of classes stands on every row.
    """
    salted = members.join(homes.select("sig", "home"), "sig").select(
        "code", "sig", "n", "home", F.ceil(F.col("members") / BLOCK_PIECE).cast("int").alias("_pieces")
    ).withColumn("_piece", F.pmod(F.xxhash64("sig"), F.col("_pieces")).cast("int"))
    per_home = salted.groupBy("code", "home").agg(F.count(F.lit(1)).alias("_c"), F.max("_pieces").alias("_pieces"))
    main = per_home.groupBy("code").agg(F.max(F.struct("_c", "home"))["home"].alias("main"), F.count(F.lit(1)).alias("_homes"), F.max("_pieces").alias("_pieces"))
    pieces = F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1))
    mixed = written(salted.join(main.where("_homes > 1").select("code", "main", pieces.alias("_piece")), ["code", "_piece"]), "mixed-blocks")
    outside = mixed.where("home <> main").select("code", pieces.alias("_piece"), F.col("sig").alias("a"), F.col("n").alias("an"), F.col("home").alias("ah"))
    block = mixed.select("code", "_piece", F.col("sig").alias("b"), F.col("n").alias("bn"), F.col("home").alias("bh"))
    pairs = outside.join(block, ["code", "_piece"]).where("ah <> bh and 5 * least(an, bn) >= 4 * greatest(an, bn)")
    first = F.expr("an < bn or (an = bn and a < b)")
    return pairs.select(
        F.when(first, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("v"), F.greatest("an", "bn").alias("vn")
    ).distinct()


def _first_targets(placed: DataFrame, across: DataFrame) -> DataFrame:
    """sig, target of every set to be shipped: its own piece, piece 0 with each other piece, and listed pairs."""
    pieces = placed.select("home", "piece").distinct()
    own = placed.select("sig", F.struct(F.lit(0).alias("kind"), F.col("home").alias("k1"), F.col("piece").alias("k2"), F.col("piece").alias("k3"), F.lit(False).alias("is_query"), F.col("sig").alias("root")).alias("target"))
    later = pieces.where("piece > 0").withColumnRenamed("piece", "other")
    # classes of piece 0 go to every other piece's group, the others to their own piece's
    with_zero = placed.where("piece = 0").join(later, "home").unionByName(placed.where("piece > 0").withColumn("other", F.col("piece")))
    zero = with_zero.select("sig", F.struct(F.lit(0).alias("kind"), F.col("home").alias("k1"), F.lit(0).alias("k2"), F.col("other").alias("k3"), F.lit(False).alias("is_query"), F.col("sig").alias("root")).alias("target"))
    degree = across.groupBy("u").agg(F.count(F.lit(1)).alias("_d"), F.max("vn").alias("_n"))
    degree = degree.select("u", F.greatest(F.ceil(F.col("_d") * F.col("_n") / GROUP_SHINGLES), F.lit(1)).cast("int").alias("_groups"))
    dealt = across.join(degree, "u").select("u", "v", F.pmod(F.xxhash64("v"), F.col("_groups")).cast("int").alias("g"))
    pair = lambda sig, query: F.struct(F.lit(1).alias("kind"), F.col("u").alias("k1"), F.col("g").alias("k2"), F.lit(0).alias("k3"), F.lit(query).alias("is_query"), F.col(sig).alias("root")).alias("target")
    return (
        own.unionByName(zero)
        .unionByName(dealt.select(F.col("v").alias("sig"), pair("v", False)))
        .unionByName(degree.withColumn("g", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1))).select(F.col("u").alias("sig"), pair("u", True)))
    )


def _rest_targets(placed: DataFrame, roots: DataFrame) -> DataFrame:
    """sig, target for the pairs of pieces that the first targets leave out and that aren't in one component."""
    labelled = placed.join(roots.withColumnRenamed("node", "sig"), "sig", "left").withColumn("root", F.coalesce("root", "sig"))
    edge = labelled.where("piece > 0").groupBy("home", "piece").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    a = edge.select("home", F.col("piece").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"))
    b = edge.select(F.col("home").alias("h"), F.col("piece").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"))
    tasks = a.join(b, (F.col("home") == F.col("h")) & (F.col("a") < F.col("b"))).where("least(alo, blo) <> greatest(ahi, bhi)")
    asked = tasks.select("home", "a", "b", F.explode(F.array("a", "b")).alias("piece"))
    return labelled.join(asked, ["home", "piece"]).select(
        "sig", F.struct(F.lit(0).alias("kind"), F.col("home").alias("k1"), F.col("a").alias("k2"), F.col("b").alias("k3"), F.lit(False).alias("is_query"), "root").alias("target")
    )


def search(docs: DataFrame, classes: DataFrame, targets: DataFrame) -> DataFrame:
    """(u, v, overlap): links found by T-occurrence search in the groups that the targets ask for.

    The texts of the classes asked for are shuffled once; each set goes from
    there straight to its groups.
    """
    wanted = targets.groupBy("sig").agg(F.collect_list("target").alias("targets")).join(classes, "sig").select(F.col("rep").alias("_id"), "sig", "targets")
    texts = docs.select(id_key().cast("long").alias("_id"), "text").join(wanted, "_id").select("sig", "text", "targets")
    fields = ["kind", "k1", "k2", "k3", "is_query", "root"]

    def ship(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in at.chunks(batch, "text"):
                sets = shingle_sets(part.column("text"))
                sig = part.column("sig").to_numpy()
                spans = part.column("targets")
                off = spans.offsets.to_numpy()
                flat = spans.values.slice(off[0], off[-1] - off[0])
                row = at.rows_of(np.diff(off))
                # rows that share a doc_id: only the text of the class counts
                right = np.array([_signature(s) == k for s, k in zip(sets, sig.tolist())], bool)
                take = np.flatnonzero(right[row])
                for a in range(0, len(take), 500):
                    i = take[a : a + 500]
                    yield pa.record_batch(
                        [flat.field(f).take(pa.array(i)) for f in fields] + [pa.array(sig[row[i]]), pa.array([sets[k].tobytes() for k in row[i].tolist()], pa.binary())],
                        names=[*fields, "sig", "set"],
                    )

    def run(table: pa.Table) -> pa.Table:
        sig, once = np.unique(table.column("sig").to_numpy(), return_index=True)
        raw = table.column("set")
        own = [np.frombuffer(raw[int(i)].as_py(), at.U64) for i in once]
        names, number = np.unique(table.column("root").to_numpy()[once], return_inverse=True)
        if table.column("kind")[0].as_py() == 0:
            # links inside the component that most belong to aren't looked for
            common = int(np.bincount(number).argmax()) if len(names) < len(sig) else -1
            queries = np.flatnonzero(number != common).tolist()
        else:
            queries = np.flatnonzero(table.column("is_query").to_numpy()[once]).tolist()
        index = ListIndex(own)
        parent = list(range(len(names)))

        def top(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        out: list[tuple[int, int, int]] = []
        for q in queries:
            for i, n in zip(*(x.tolist() for x in index.search(own[q]))):
                a, b = top(int(number[q])), top(int(number[i]))
                if a != b:  # one link joins them; more between them say nothing new
                    parent[max(a, b)] = min(a, b)
                    out.append((int(sig[q]), int(sig[i]), n))
        cols = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in cols], names=["u", "v", "overlap"])

    shipped = texts.mapInArrow(ship, "kind int, k1 long, k2 int, k3 int, is_query boolean, root long, sig long, set binary")
    return shipped.groupBy("kind", "k1", "k2", "k3").applyInArrow(run, "u long, v long, overlap long")


def class_links(docs: DataFrame, shards: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents: id, n, sig), (classes: sig, rep), (component roots: node, root) over class signatures."""
    shards = shards or shards_for(docs, bytes_each=32 << 20)
    rows = profile(docs)
    documents = rows.where("kind = 0").select("id", "n", "sig")
    classes = documents.where("n > 0").groupBy("sig").agg(F.min("id").alias("rep"))
    counters = rows.where("kind = 1").select(F.col("id").alias("segment"), "counts")
    freq = docs.sparkSession.sparkContext.broadcast(rarity.merged(counters))
    members = written(_prune(written(blocks(docs, freq, shards), "blocks")), "pruned")
    placed = written(_homes(members), "homes")
    across = written(_across(members, placed), "pairs")
    placed = written(_pieces(placed), "pieces")
    links = written(search(docs, classes, _first_targets(placed, across)), "links")
    roots = connected_components(links)
    rest = written(_rest_targets(placed, roots), "rest")
    if not rest.isEmpty():
        more = written(search(docs, classes, rest), "rest-links")
        roots = connected_components(links.select("u", "v").union(more.select("u", "v")))
    return documents, classes, roots


def components(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    documents, classes, roots = class_links(docs, shards)
    labelled = classes.join(roots.withColumnRenamed("node", "sig"), "sig", "left").select("sig", "rep", F.coalesce("root", "sig").alias("root"))
    least = labelled.groupBy("root").agg(F.min("rep").alias("component"))
    label = labelled.join(least, "root").select("sig", "component")
    out = documents.join(label, "sig", "left").select("id", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component"))
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return out.select(real("id").alias("doc_id"), F.col("n").alias("n_shingles"), real("component").alias("component_id"))


def one_per_group(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The documents with the smallest doc_id of their component; of rows that repeat such an id, one with each text."""
    found = components(docs, shards)
    keep = found.where("doc_id <=> component_id").select(id_key().alias("_id")).distinct()
    return docs.withColumn("_id", id_key().cast("long")).join(keep, "_id", "left_semi").drop("_id")
