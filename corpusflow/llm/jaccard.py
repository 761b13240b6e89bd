"""Near-duplicate texts: an exact Jaccard join over word shingles with token-combination prefixes.

Shingles stand in one order for all texts: first those that no other text has, then light ones, then heavy
ones, each by hash. Similar texts share much of a prefix of that order. A prefix is indexed by its light
shingles one by one and by pairs of its heavy ones; shingles of one text alone need no entry. So most
texts, whose prefix is their own, meet nobody, and a passage in thousands of texts brings no two of them
together. The prefix is extended as far as the pairs need. For pairs, heavy shingles fall into groups
by leading bits of their hash, about four to eight of a text in each, and only pairs within a group are
indexed: a prefix of p shingles has a few times p index entries, never p squared.

Every text is a class of its set of shingles; copies are one class from the start. Classes that share an
entry are candidates. First each is verified against the least class of the entry and what is similar
is connected; then what shares an entry and lies in different components is verified: pair by pair under
light shingles, which few texts have, and block by block under heavy ones, where a task holds two bounded
blocks of sets and returns only the links that join components. So no link between different components
is missed, and a group of thousands of near copies is never paired off in a table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.llm.bpe import spans
from corpusflow.llm.components import components
from corpusflow.llm.pretokens import mix
from corpusflow.llm.slices import bound_batches, slices
from corpusflow.llm.words import shingles, split_words
from corpusflow.session import stage

# Bits of each of the two maps that tell shared and heavy shingles (8 MB each): a shingle whose bit is set by
# another one is taken for more common than it is, which costs work and changes no result.
MAP_BITS = 26
CHUNK_BITS = 16
# Texts that a light shingle is in at most; more, if the heavy ones would fill an eighth of their map.
LIGHT = 16
# Bytes of sets in a block; a task verifies two blocks.
BLOCK_BYTES = 4 << 20
# Rows of a table of hashes up to which it is broadcast (16 to 24 bytes a row).
BROADCAST_ROWS = 1_000_000


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def low_end(num: int, den: int) -> np.uint64:
    """Shingles below this hash are counted: two and a half times the share that a prefix takes."""
    return np.uint64(min(int(2.5 * (den - num) / den * 2.0**64), (1 << 64) - 1))


def _place(tokens: np.ndarray) -> np.ndarray:
    return (mix(tokens) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


@dataclass
class Classes:
    """How common shingles are: two maps of bits, and the end of the range of hashes that was counted."""

    low: np.uint64
    shared: np.ndarray
    heavy: np.ndarray

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """0 for shingles of one text, 1 for light, 2 for heavy ones and those not counted."""
        place = _place(tokens)
        bit = np.uint8(1) << (place & 7).astype(np.uint8)
        kind = ((self.shared[place >> 3] & bit) > 0).astype(np.int8) + ((self.heavy[place >> 3] & bit) > 0)
        return np.where(tokens < self.low, kind, 2)


def set_key(tokens: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    if not len(tokens):
        return 0
    total = np.add.reduce(mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5))) + np.uint64(len(tokens))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def prefix_entries(tokens: np.ndarray, kind: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Entries of a set of sorted shingles: light ones, pairs of heavy ones, and the length of a prefix without heavy ones, else 0.

    ``kind``: 0 for shingles that no other set has, 1 light, 2 heavy. Two different sets with
    ``den * intersection >= num * union`` share an entry.
    """
    n = len(tokens)
    needed = n + 1 + (-num * n) // den  # one more than the shingles that a similar set may lack
    own = int((kind == 0).sum())
    if own >= needed or (needed <= 1 and den * n // num <= n):
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.uint64), 0  # nobody is similar, or only an equal set
    light = tokens[kind == 1][: needed - own]
    pairs, short = [np.zeros(0, dtype=np.uint64)], needed - own - len(light)
    if short:
        heavy = tokens[kind == 2]
        level = n.bit_length() - 1
        least_partner = -((-num * n) // den)
        for lv in (level, level - 1) if least_partner.bit_length() - 1 < level else (level,):
            bits = max(lv - 2, 0)
            group = heavy >> np.uint64(64 - bits) if bits else np.zeros(len(heavy), dtype=np.uint64)
            counts = np.cumsum(np.concatenate([[0], (group[1:] == group[:-1]).astype(np.int64)])) if len(group) else group
            stop = int(np.searchsorted(counts, short)) + 1
            part, group = heavy[:stop], group[:stop]
            for gap in range(1, len(part)):
                same = group[gap:] == group[:-gap]
                if not same.any():
                    break
                pairs.append(mix(mix(part[:-gap][same] + np.uint64(lv + 1)) + part[gap:][same]))
    return mix(light), np.unique(np.concatenate(pairs)), 0 if short else needed


def _profile(df: DataFrame, width: int) -> DataFrame:
    """(doc, body, n, cls) of every text: the size and the name of its set."""

    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys = [], []
            for part in slices(batch.column(1).to_pylist()):
                for tokens in shingles(split_words(part), width):
                    sizes.append(len(tokens))
                    keys.append(set_key(tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64())], names=["doc", "body", "n", "cls"]
            )

    return stage(df.mapInArrow(profile, "doc long, body long, n long, cls long"), "shingle-profile")


def _classes(df: DataFrame, width: int, num: int, den: int) -> Classes:
    """Count the shingles of the low range in all texts; mark the shared and the heavy ones."""
    low = low_end(num, den)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0).to_pylist()):
                sets = [tokens[: np.searchsorted(tokens, low)] for tokens in shingles(split_words(part), width)]
                tokens = np.concatenate([np.zeros(0, np.uint64), *sets])
                yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64))], names=["token"])

    counts = df.select("text").mapInArrow(emit, "token long").groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    counts = stage(counts, "shingle-counts")
    steps = [1 << k for k in range(1, 40)]
    sizes = counts.agg(*[F.count(F.when(F.col("k") >= s, 1)).alias(f"c{s}") for s in steps]).first()
    least = next(s for s in steps if s > LIGHT and sizes[f"c{s}"] <= (1 << MAP_BITS) // 8)
    full = sizes["c2"] > (1 << MAP_BITS) // 2  # then the map would tell nothing: all count as shared

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            place = np.asarray(batch.column(0))
            heavy = np.asarray(batch.column(1)) >= least
            for chunk in np.unique(place >> CHUNK_BITS).tolist():
                bits = held.setdefault(chunk, np.zeros((2, 1 << CHUNK_BITS), dtype=bool))
                own = place >> CHUNK_BITS == chunk
                at = place[own] & ((1 << CHUNK_BITS) - 1)
                bits[0, at] = True
                bits[1, at[heavy[own]]] = True
        packed = [[np.packbits(x[k], bitorder="little").tobytes() for x in held.values()] for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), *(pa.array(x, pa.binary()) for x in packed)], names=["chunk", "shared", "heavy"])

    @F.arrow_udf(T.LongType())
    def place(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array(_place(np.asarray(batch).view(np.uint64)))

    wanted = counts.where(F.col("k") >= (least if full else 2))
    placed = wanted.select(place("token").alias("place"), "k")
    parts = placed.repartition(F.shiftright("place", CHUNK_BITS)).mapInArrow(mark, "chunk int, shared binary, heavy binary")
    maps = np.zeros((2, 1 << (MAP_BITS - 3)), dtype=np.uint8)
    size = 1 << (CHUNK_BITS - 3)
    for row in parts.collect():  # the two maps, cut into chunks: 16 MB whatever the input
        for k, name in enumerate(("shared", "heavy")):
            maps[k, row["chunk"] * size : (row["chunk"] + 1) * size] |= np.frombuffer(row[name], dtype=np.uint8)
    if full:
        maps[0] = 255
    return Classes(low, maps[0], maps[1])


def _entries(df: DataFrame, width: int, num: int, den: int, classes: Classes) -> DataFrame:
    """(entry, cls, n, p, heavy) of every text: size of its set, and of its prefix if no heavy shingle is in it."""
    shared = df.sparkSession.sparkContext.broadcast(classes)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1).to_pylist()):
                found, keys, sizes, prefix, heavy = [np.zeros(0, np.uint64)], [], [], [], []
                for tokens in shingles(split_words(part), width):
                    light, pairs, length = prefix_entries(tokens, shared.value.of(tokens), num, den)
                    for entries, of_pairs in ((light, False), (pairs, True)):
                        if len(entries):
                            found.append(entries)
                            keys.append(set_key(tokens))
                            sizes.append(len(tokens))
                            prefix.append(length)
                            heavy.append(of_pairs)
                lengths = [len(x) for x in found[1:]]
                columns = [np.repeat(np.array(x, t), lengths) for x, t in ((keys, np.int64), (sizes, np.int32), (prefix, np.int32), (heavy, bool))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(found).view(np.int64)), *map(pa.array, columns)], names=["entry", "cls", "n", "p", "heavy"]
                )

    return stage(df.mapInArrow(index, "entry long, cls long, n int, p int, heavy boolean"), "shingle-entries")


def _sets(df: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(cls, tokens) of the wanted classes, each from one document: tokens are the sorted hashes."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1).to_pylist()):
                sets = list(shingles(split_words(part), width))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(map(set_key, sets), pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["cls", "tokens"]
                )

    one = lambda kind: df.join(_small(wanted.where(kind)), ["doc", "body"] if kind == "doc is not null" else "body", "left_semi").where(kind)
    # Rows without id that are equal are no more than one document here.
    docs = one("doc is not null").unionByName(one("doc is null").dropDuplicates(["body"])).select("doc", "text")
    return stage(docs.mapInArrow(compute, "cls long, tokens binary"), "shingle-sets")


@F.arrow_udf(T.LongType())
def _shared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Size of the intersection of two sorted arrays of hashes."""
    for left, right in batches:
        counts = []
        for a, b in zip(left, right):
            x, y = np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64)
            at = np.minimum(np.searchsorted(y, x), len(y) - 1)
            counts.append(int((y[at] == x).sum()))
        yield pa.array(counts, pa.int64())


def _verified(pairs: DataFrame, df: DataFrame, classes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) that are similar indeed."""
    ends = pairs.select(F.col("a").alias("cls")).unionByName(pairs.select(F.col("b").alias("cls"))).distinct()
    sets = _sets(df, _wanted(classes, ends), width)
    met = pairs.join(sets.select(F.col("cls").alias("a"), F.col("tokens").alias("x")), "a")
    met = met.join(sets.select(F.col("cls").alias("b"), F.col("tokens").alias("y")), "b")
    both = F.octet_length("x") / 8 + F.octet_length("y") / 8
    shared = met.select("a", "b", _shared("x", "y").alias("shared"), both.cast("long").alias("both"))
    return stage(shared.where(den * F.col("shared") >= num * (F.col("both") - F.col("shared"))).select("a", "b").distinct(), "similar")


def _wanted(classes: DataFrame, ends: DataFrame) -> DataFrame:
    """A document (id and hash of the text) of each class of ``ends``."""
    return stage(classes.join(ends, "cls", "left_semi").select(F.col("rep.doc").alias("doc"), F.col("rep.body").alias("body")), "wanted")


def _blocked(members: DataFrame, known: DataFrame, df: DataFrame, classes: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Links (a, b) among the classes that meet under entries of ``members``, where they join components.

    What hangs together by entries is a cluster. A cluster is cut into blocks by bytes; each pair of blocks
    is one task's group, which finds all similar pairs between them and returns those that join components.
    """
    least = members.groupBy("entry").agg(F.min("cls").alias("a"))
    clusters = components(members.join(least, "entry").select("a", F.col("cls").alias("b")).distinct())
    clusters = stage(clusters.select(F.col("node").alias("cls"), F.col("root").alias("cluster")), "clusters")
    sets = _sets(df, _wanted(classes, clusters.select("cls")), width).join(clusters, "cls").join(known.withColumnRenamed("node", "cls"), "cls", "left")
    sets = stage(sets.withColumn("root", F.coalesce("root", "cls")), "cluster-sets")
    sizes = sets.groupBy("cluster").agg((1 + F.floor(F.sum(F.octet_length("tokens")) / BLOCK_BYTES)).cast("int").alias("blocks"))
    cut = sets.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})

    def verify(group: pa.Table) -> pa.Table:
        of = dict(zip(group["cls"].to_pylist(), zip(group["block"].to_pylist(), group["tokens"].to_pylist(), group["root"].to_pylist())))
        i, j = group["i"][0].as_py(), group["j"][0].as_py()
        left, right = ([c for c in of if of[c][0] == k] for k in (i, j))
        if not left or not right:  # a block into which no class of the cluster fell
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        arrays = {c: np.frombuffer(x[1], dtype=np.uint64) for c, x in of.items()}
        size = np.array([len(arrays[c]) for c in right])
        tokens = np.concatenate([arrays[c] for c in right])
        owner = np.repeat(np.arange(len(right)), size)
        order = np.argsort(tokens, kind="stable")
        tokens, owner = tokens[order], owner[order]
        root = {x[2]: x[2] for x in of.values()}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        links = []
        for c in left:
            low = np.searchsorted(tokens, arrays[c])
            count = np.searchsorted(tokens, arrays[c], side="right") - low
            common = np.bincount(owner[spans(low, count)], minlength=len(right))
            for k in np.flatnonzero(den * common >= num * (len(arrays[c]) + size - common)).tolist():
                x, y = find(of[c][2]), find(of[right[k]][2])
                if x != y:
                    root[max(x, y)] = min(x, y)
                    links.append((c, right[k]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return stage(dealt.select("cluster", "i", "j", "cls", "block", "root", "tokens").groupBy("cluster", "i", "j").applyInArrow(verify, "a long, b long"), "block-links")


def _alike(num: int, den: int) -> Column:
    """Are the sizes na, nb close enough for a similar pair?"""
    return den * F.least("na", "nb") >= num * F.greatest("na", "nb")


def _sharing(met: DataFrame, num: int, den: int, part: float) -> DataFrame:
    """Pairs (a, b) that meet under ``part`` of as many entries as a similar pair has to.

    A similar pair has ceil(num * (na + nb) / (num + den)) shingles in common, so each set lacks at most
    the rest, and all but so many of its prefix are in the other's, whichever of the two ends first.
    """
    common = F.ceil(num * (F.col("na") + F.col("nb")) / (num + den))
    least = F.least(F.col("pa") - F.col("na"), F.col("pb") - F.col("nb")) + common
    needed = F.when((F.col("pa") > 0) & (F.col("pb") > 0), least * part).otherwise(1)
    return met.groupBy("a", "b", "na", "nb", "pa", "pb").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= needed).select("a", "b")


def jaccard_components(df: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(``doc``, ``n_shingles``, ``component_id``) for every row of ``df``.

    Two texts link when ``den * intersection >= num * union`` of their sets of ``width``-word shingles
    (see ``words.shingles``); ``component_id`` is the least ``doc`` that links lead to, the own included.
    Texts without words, and NULL ones, link with nothing. Repeated rows come out each. Rows without
    ``doc`` take part, but lend no id: alone, their component is NULL. An empty table stays empty.
    Sets are told apart by 64-bit hashes; similarity is verified on whole sets.
    """
    if not 3 * den <= 5 * num <= 5 * den:
        raise ValueError("the similarity has to be from 0.6 to 1: groups of frequent shingles are made for that")
    found = jaccard_groups(df, doc, text, width, num, den)
    return found.select(F.col("doc").alias(doc), F.col("n").alias("n_shingles"), "component_id")


def jaccard_groups(df: DataFrame, doc: str = "doc_id", text: str = "text", width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """(doc, body, n, group, component_id) for every row of ``df``: see ``jaccard_components``.

    ``body`` is ``xxhash64`` of the text, so that rows of one id and different texts can be told apart;
    ``group`` names the component (NULL for a text without words), also where no row of it has an id.
    """
    bound_batches(df.sparkSession)
    rows = df.select(F.col(f"`{doc}`").cast("long").alias("doc"), F.col(f"`{text}`").alias("text"), F.xxhash64(F.col(f"`{text}`")).alias("body"))
    docs = _profile(rows, width)
    # Of each class one document gives its set: that of the least id, or one without id where no other is.
    first = F.min(F.struct(F.col("doc").isNull().alias("none"), "doc", "body"))
    classes = stage(docs.where("n > 0").groupBy("cls").agg(first.alias("rep")), "classes")
    entries = _entries(rows, width, num, den, _classes(rows, width, num, den))

    shared = entries.groupBy("entry").agg(F.min("cls").alias("least"), F.max("cls").alias("most")).where("least != most")
    shared = stage(shared.select("entry", "least"), "shared-entries")
    members = stage(entries.join(_small(shared), "entry").distinct(), "entry-members")

    first = members.where("cls = least").select("entry", F.col("n").alias("na"), F.col("p").alias("pa"))
    stars = members.where("cls != least").join(first, "entry").select(F.col("least").alias("a"), F.col("cls").alias("b"), "na", "pa", F.col("n").alias("nb"), F.col("p").alias("pb"))
    # A pair may meet under other least classes too, so here half of the entries it needs will do.
    stars = stage(_sharing(stars.where(_alike(num, den)), num, den, 0.5), "star-pairs")
    links = _verified(stars, rows, classes, width, num, den)

    known = components(links)
    placed = members.join(known.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    placed = stage(placed.select("entry", "cls", "n", "p", "heavy", "root"), "placed")
    open_entries = placed.groupBy("entry").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low != high").select("entry")
    rest = stage(placed.join(_small(stage(open_entries, "open-entries")), "entry", "left_semi"), "open-members")
    few = rest.where("not heavy")
    left = few.select("entry", F.col("cls").alias("a"), F.col("n").alias("na"), F.col("p").alias("pa"), F.col("root").alias("ra"))
    right = few.select("entry", F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("p").alias("pb"), F.col("root").alias("rb"))
    pairs = left.join(right, "entry").where((F.col("ra") != F.col("rb")) & (F.col("a") < F.col("b")) & _alike(num, den))
    pairs = stage(_sharing(pairs, num, den, 1.0).join(stars, ["a", "b"], "left_anti"), "open-pairs")
    # What the first links brought together is stars already; only the new links can join them.
    links = known.select(F.col("node").alias("a"), F.col("root").alias("b"))
    if not pairs.isEmpty():
        links = links.unionByName(_verified(pairs, rows, classes, width, num, den))
    heavy = rest.where("heavy")
    if not heavy.isEmpty():
        links = links.unionByName(_blocked(heavy, known, rows, classes, width, num, den))

    roots = components(links).withColumnRenamed("node", "cls")
    owned = classes.join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    owned = stage(owned, "class-roots")
    names = owned.groupBy("root").agg(F.min("rep.doc").alias("component_id"))
    named = stage(owned.join(names, "root").select("cls", F.col("root").alias("group"), "component_id"), "class-components")
    out = docs.where("n > 0").join(named, "cls").select("doc", "body", "n", "group", "component_id")
    alone = docs.where("n = 0").select("doc", "body", "n", F.lit(None).cast("long").alias("group"), F.col("doc").alias("component_id"))
    return out.unionByName(alone)
