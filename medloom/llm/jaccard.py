"""Similarity join of documents by the Jaccard similarity of their word n-grams, exact, without listing all pairs.

The join is a product of the sparse matrix of documents by n-grams with its transpose, of which only blocks that can
hold an entry at the threshold are computed.

1. One pass over the texts gives every document's set size and set digests. Documents with equal sets form one class.
2. Meetings. Sizes bound how much two linked sets can differ: of n-grams in one set only there are at most
   d = (1 - t) / (1 + t) times the sum of the sizes. So if the n-grams are dealt into more than d parts by hash, linked
   sets agree on a whole part. The number of parts follows from the size class of the larger set; a set can be the
   larger or the smaller one, so it has two dealings. Each task sends the digests of the parts of each class of equal
   sets once. Classes with an equal part meet; meetings of the same classes count once.
3. Blocks. Sets also share parts by chance, above all those of passages. Each class therefore has a row of counts: how many
   of its n-grams fall into each of about an eighth as many cells. Counts of linked sets differ by d in sum at most, those of
   unrelated sets by far more. Classes that meet and pass this test are joined, and the connected components of the
   joins are the blocks of the product: links never leave a block, and a block is hardly larger than a component.
   A meeting of more than ``MEETING`` classes is dealt into pieces that are tested pairwise, in tasks of their own.
4. Each block is multiplied in one task, document by document: an index of set prefixes, ordered by the block's own
   counts, gives the columns that can be non-zero, sizes discard more of them, and overlaps of the rest are
   accumulated over whole sets. A document linked to an earlier one needs no row of its own unless its component is
   not the block's largest, so a block of near copies costs a row, not a square. A block above ``BLOCK_GRAMS`` is dealt
   into parts, and every two parts are multiplied in a task of their own.
5. Tasks return spanning edges only. Their connected components are the result.

Hashes of n-grams have 64 bits, digests of sets 128.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medloom.llm.components import Forest, components
from medloom.llm.exact import first_of_each, row_hash
from medloom.llm.mapping import arrow_map
from medloom.llm.rolling import SECOND, chunks, gram_hashes, mix, prefix_sums, ranges, stretch_hash, word_layout
from medloom.llm.stretches import keyed, same_row
from medloom.sources.shared import written

PERCENT = 85
WORDS = 4
BLOCK_GRAMS = 4_000_000
MEETING = 16_384
#: The least number of cells of a row of counts, and how many n-grams share one in larger sets.
CELLS, GRAMS_A_CELL = 64, 8
U = np.uint64


def gram_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct word n-grams of each text, end to end and sorted in each text, and the set sizes.

    A text with fewer words is one gram; a text without words has none.
    """
    tokens, starts, ends, *_ = word_layout(texts, lower=True)
    length = ends - starts
    counts = np.where(length >= words, length - words + 1, np.minimum(length, 1))
    grams = np.empty(int(counts.sum()), U)
    at = np.cumsum(counts) - counts
    long = np.flatnonzero(length >= words)
    if len(long):
        grams[ranges(at[long], counts[long])] = gram_hashes(tokens, words)[ranges(starts[long], counts[long])]
    short = np.flatnonzero((length > 0) & (length < words))
    if len(short):
        sums = prefix_sums(tokens)
        grams[at[short]] = mix(stretch_hash(sums, starts[short], ends[short]) + length[short].astype(U))
    for a, n in zip(at[long].tolist(), counts[long].tolist(), strict=True):
        grams[a : a + n].sort()
    owner = np.repeat(np.arange(len(texts)), counts)
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[fresh], np.bincount(owner[fresh], minlength=len(texts))


def _set_digests(grams: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ends = np.cumsum(sizes)
    out = []
    for salt in (U(0), SECOND):
        sums = np.zeros(len(grams) + 1, U)
        np.cumsum(mix(grams + salt), out=sums[1:])
        out.append(mix(sums[ends] - sums[ends - sizes] + sizes.astype(U)))
    return out[0], out[1]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t.encode() for t in batch.column("_text").to_pylist()]


def count_rows(grams: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """For each set how many of its elements fall into each cell (at most 255), the cells going by the highest bits."""
    bits = np.maximum(CELLS, sizes // GRAMS_A_CELL)
    bits = np.ceil(np.log2(np.maximum(bits, 1))).astype(np.int64)
    cells = np.int64(1) << bits
    base = np.cumsum(cells) - cells
    at = (mix(grams + SECOND) >> np.repeat(U(64) - bits.astype(U), sizes)).astype(np.int64) + np.repeat(base, sizes)
    counts = np.minimum(np.bincount(at, minlength=int(cells.sum())), 255).astype(np.uint8).tobytes()
    return [counts[b : b + n] for b, n in zip(base.tolist(), cells.tolist(), strict=True)]


def folded(rows: list[bytes]) -> np.ndarray:
    """Rows of counts as a matrix with as many cells as the shortest has: neighbouring cells are added."""
    least = min(map(len, rows))
    out = np.empty((len(rows), least), np.int32)
    for i, row in enumerate(rows):
        out[i] = np.frombuffer(row, np.uint8).reshape(least, -1).sum(axis=1, dtype=np.int32)
    return out


def _survey(words: int) -> Callable:
    """Set size, digests and counts of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in chunks(_texts(batch)):
                grams, sizes = gram_sets(group, words)
                one, two = _set_digests(grams, sizes)
                kept = {c: batch.column(c).slice(first, len(group)) for c in ("_id", "_hash")}
                own = {"n": sizes.astype(np.int64), "one": one.view(np.int64), "two": two.view(np.int64)}
                counts = {"counts": pa.array(count_rows(grams, sizes), pa.binary())}
                yield pa.RecordBatch.from_pydict(kept | {k: pa.array(v) for k, v in own.items()} | counts)

    return run


def prefix_sizes(sizes: np.ndarray, percent: int) -> np.ndarray:
    """How many first elements of a set must be looked at: its size less the least overlap, and one."""
    return sizes - (percent * sizes + 99) // 100 + 1


def size_classes(most: int, percent: int) -> np.ndarray:
    """Least sizes of classes: a set and any smaller one linked to it lie in the same or in neighbouring classes."""
    least = [1]
    while least[-1] <= most:
        least.append(100 * least[-1] // percent + 1)
    return np.array(least, np.int64)


def part_digests(grams: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Digests of the parts of each set (not empty), end to end, and how many digests each set has.

    A set of size class c is dealt as the larger set of a pair (class c) and as the smaller one (class c + 1). The
    larger set of class c has at most ``top[c]`` elements, so linked sets agree on all but ``differ[c]`` parts. A few
    parts more are made, so that they agree on one that is not empty; sets with more empty parts than that also
    have digests of their empty parts.
    """
    least = size_classes(int(sizes.max()), percent)
    least = np.append(least, size_classes(int(least[-1]) * 100 // percent + 1, percent)[len(least) : len(least) + 2])
    top = least[1:] - 1
    differ = 2 * top * (100 - percent) // (100 + percent)
    # as many as are empty by chance in the smallest set that a set of the class can be linked to, and some deviations
    tokens, spare = percent / 100 * least[:-1], np.zeros(len(top), np.int64)
    for _ in range(3):
        empty = (differ + 1 + spare) * np.exp(-tokens / (differ + 1 + spare)) * (differ > 0)
        spare = np.ceil(empty + np.where(differ < 16, 2.0, 3.5) * np.sqrt(empty)).astype(np.int64)
    parts = differ + 1 + spare
    own = np.searchsorted(least, sizes, side="right") - 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    content = mix(grams ^ SECOND)
    high = grams >> U(32)
    out, owners = [], []
    for level in (own, own + 1):
        count = parts[level]
        base = np.cumsum(count) - count
        slot = ((high * count[owner].astype(U)) >> U(32)).astype(np.int64) + base[owner]  # ascending: grams are sorted
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1]))
        held = owner[first]
        name = (slot[first] - base[held]).astype(U) + (level[held].astype(U) << U(40))
        out.append(mix(np.add.reduceat(content, first) + mix(name)))
        owners.append(held)
        full = np.bincount(held, minlength=len(sizes))
        for i in np.flatnonzero(count - full > spare[level]).tolist():
            filled = slot[first[held == i]] - base[i]
            empty = np.setdiff1d(np.arange(count[i]), filled).astype(U)
            out.append(mix(mix(empty + (level[i].astype(U) << U(40))) + SECOND))
            owners.append(np.full(len(empty), i))
    owner = np.concatenate(owners)
    turn = np.argsort(owner, kind="stable")
    return np.concatenate(out)[turn], np.bincount(owner, minlength=len(sizes))


def _parts(words: int, percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for _, group in chunks(_texts(batch)):
                grams, sizes = gram_sets(group, words)
                one, _ = _set_digests(grams, sizes)
                new = np.zeros(len(group), bool)
                for i, (digest, n) in enumerate(zip(one.tolist(), sizes.tolist(), strict=True)):
                    if n and digest not in sent:
                        sent.add(digest)
                        new[i] = True
                if not new.any():
                    continue
                digests, counts = part_digests(grams[np.repeat(new, sizes)], sizes[new], percent)
                columns = {"part": pa.array(digests.view(np.int64)), "class": pa.array(np.repeat(one[new].view(np.int64), counts))}
                yield from pa.table(columns).to_batches(max_chunksize=100_000)

    return run


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The classes of parts that several classes have; rows arrive sorted by part and class."""
    carry, met = tuple(np.empty(0, np.int64) for _ in range(2)), False  # the last row, and whether it met the one before

    def shown(part: np.ndarray, kind: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"part": pa.array(part), "class": pa.array(kind)})

    for batch in batches:
        part, kind = (np.append(c, batch.column(k).to_numpy()) for c, k in zip(carry, ("part", "class"), strict=True))
        if not len(part):
            continue
        fresh = np.append(True, (part[1:] != part[:-1]) | (kind[1:] != kind[:-1]))
        part, kind = part[fresh], kind[fresh]
        same = part[1:] == part[:-1]
        several = np.append(met, same) | np.append(same, False)
        met = bool(several[-1])
        carry = (part[-1:], kind[-1:])
        if several[:-1].any():
            yield shown(part[:-1][several[:-1]], kind[:-1][several[:-1]])
    if met:
        yield shown(*carry)


def _tested(percent: int) -> Callable:
    """Joins between classes that meet and whose counts allow a link; rows arrive sorted by meeting and piece numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, kinds, sizes, rows = None, [], [], []

        def done() -> Iterator[pa.RecordBatch]:
            edges = allowed_links(np.array(sizes, np.int64), folded(rows), percent) if len(rows) > 1 else []
            if edges:
                a, b = np.array(kinds, np.int64)[np.array(edges)].T
                yield pa.RecordBatch.from_pydict({"a": pa.array(a), "b": pa.array(b)})

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("part", "i", "j", "class", "n", "counts"))
            for part, i, j, kind, n, counts in zip(*columns, strict=True):
                if (part, i, j) != key:
                    yield from done()
                    key, kinds, sizes, rows = (part, i, j), [], [], []
                kinds.append(kind)
                sizes.append(n)
                rows.append(counts)
        yield from done()

    return run


def allowed_links(sizes: np.ndarray, counts: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Pairs whose sizes and counts allow a link, enough of them to give all connected components."""

    def row(x: int, among: np.ndarray | None = None) -> np.ndarray:
        near = (100 * sizes >= percent * sizes[x]) & (100 * sizes[x] >= percent * sizes)
        near[x] = False
        if among is not None:
            near &= among
        at = np.flatnonzero(near)
        apart = np.abs(counts[at] - counts[x]).sum(axis=1)
        return at[(100 + percent) * apart <= (100 - percent) * (sizes[at] + sizes[x])]

    return spanning(len(sizes), row)


def spanning(m: int, row: Callable) -> list[tuple[int, int]]:
    """Edges that give all connected components, from ``row(x, among)``: the neighbours of x, of those in ``among``.

    A neighbour of an earlier element needs no row of its own unless it lies outside the largest component.
    """
    forest, edges, absorbed = Forest(m), [], np.zeros(m, bool)
    for x in range(m):
        if absorbed[x]:
            continue
        linked = row(x)
        absorbed[linked] = True
        edges += [(x, y) for y in linked.tolist() if forest.join(x, y)]
        if len(edges) == m - 1:
            return edges
    # pairs of absorbed elements in different components: at least one is outside the largest component
    roots = np.array([forest.root(i) for i in range(m)])
    largest = np.bincount(roots).argmax()
    for x in np.flatnonzero(absorbed & (roots != largest)).tolist():
        edges += [(x, y) for y in row(x, absorbed & (roots != roots[x])).tolist() if forest.join(x, y)]
    return edges


def _sets(words: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in chunks(_texts(batch)):
                grams, sizes = gram_sets(group, words)
                ends = np.cumsum(sizes)
                raw = memoryview(grams.astype("<u8").tobytes())
                own = [bytes(raw[8 * (e - s) : 8 * e]) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                kept = {c: batch.column(c).slice(first, len(group)) for c in ("_id", "block", "parts")}
                yield pa.RecordBatch.from_pydict(kept | {"grams": pa.array(own, pa.binary())})

    return run


def spanning_links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between sets, enough of them to give all connected components."""
    m = len(sets)
    if m < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    _, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    grams = rank[number]
    for a, n in zip(starts.tolist(), sizes.tolist(), strict=True):
        grams[a : a + n].sort()
    prefix = prefix_sizes(sizes, percent)
    held = grams[ranges(starts, prefix)]
    turn = np.argsort(held, kind="stable")
    posting_docs = np.repeat(np.arange(m), prefix)[turn]
    bounds = np.searchsorted(held[turn], np.arange(len(count) + 1))
    mark = np.zeros(len(count), bool)

    def row(x: int, among: np.ndarray | None = None) -> np.ndarray:
        """The sets linked to set x, of those flagged in ``among`` if given."""
        own = grams[starts[x] : starts[x] + prefix[x]]
        lo, hi = bounds[own], bounds[own + 1]
        docs = posting_docs[ranges(lo, hi - lo)]
        if among is not None:
            docs = docs[among[docs]]
        docs = np.unique(docs)
        docs = docs[docs != x]
        docs = docs[(100 * sizes[docs] >= percent * sizes[x]) & (100 * sizes[x] >= percent * sizes[docs])]
        if not len(docs):
            return docs
        whole = grams[starts[x] : starts[x] + sizes[x]]
        mark[whole] = True
        hits = mark[grams[ranges(starts[docs], sizes[docs])]]
        mark[whole] = False
        ends = np.cumsum(sizes[docs])
        sums = np.append(0, np.cumsum(hits))
        overlap = sums[ends] - sums[ends - sizes[docs]]
        return docs[100 * overlap >= percent * (sizes[x] + sizes[docs] - overlap)]

    return spanning(m, row)


def _multiply(percent: int) -> Callable:
    """Rows arrive sorted by block and part numbers; one product for each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, sets = None, [], []

        def done(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            edges = spanning_links(sets, percent)
            if edges:
                a, b = zip(*edges, strict=True)
                yield pa.RecordBatch.from_pydict({"a": pa.array([ids[i] for i in a], id_type), "b": pa.array([ids[i] for i in b], id_type)})

        id_type = pa.null()
        for batch in batches:
            id_type = batch.column("_id").type
            columns = (batch.column(c).to_pylist() for c in ("block", "i", "j", "_id", "grams"))
            for block, i, j, own, grams in zip(*columns, strict=True):
                if (block, i, j) != key:
                    yield from done(id_type)
                    key, ids, sets = (block, i, j), [], []
                ids.append(own)
                sets.append(np.frombuffer(grams, "<u8"))
        yield from done(id_type)

    return run


def _blocks(met: DataFrame, linking: DataFrame, percent: int, meeting: int) -> DataFrame:
    """The joins of classes: a, b. Of meetings of the same classes the one of the smallest part is tested."""
    who = (F.xxhash64("class"), F.xxhash64(F.lit(1), "class"))
    lists = met.groupBy("part").agg(F.count("*").alias("m"), *[F.bit_xor(h).alias(f"h{i}") for i, h in enumerate(who)])
    once = written(lists.groupBy("m", "h0", "h1").agg(F.min("part").alias("part")).select("part", F.ceil(F.col("m") / meeting).cast("int").alias("pieces")), "once")
    wanted = once.hint("merge")  # grows with the input: never broadcast
    asked = written(met.join(wanted, "part"), "asked")
    counts = linking.groupBy(F.col("one").alias("class")).agg(F.min(F.struct("n", "counts")).alias("own")).select("class", "own.n", "own.counts")
    own = F.pmod(F.xxhash64("class"), F.col("pieces")).cast("int").alias("own")
    dealt = asked.join(written(counts, "counts").hint("merge"), "class").select("part", "class", "n", "counts", own, F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("other"))
    dealt = dealt.select("part", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class", "n", "counts")
    pieces = dealt.repartition("part", "i", "j").sortWithinPartitions("part", "i", "j", "class")
    return arrow_map(pieces, _tested(percent), "a long, b long")


def similar_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, block_grams: int = BLOCK_GRAMS,
    meeting: int = MEETING,
) -> DataFrame:
    """Per row: the id, n_shingles (size of its set of word n-grams), component_id (smallest id reachable by links).

    Words are separated by ASCII white space, A-Z are lower-cased. A text with fewer than ``words`` words is one
    n-gram; a missing text or one without words has an empty set, linked with nothing. Two documents link when 100 *
    intersection >= percent * union. Ids are whole numbers. Rows that share an id are one document, whose links are
    those of all its texts. A row without id takes part in no link and has no component. Other columns are ignored;
    an empty table gives an empty table.
    """
    if not 0 < percent <= 100:
        raise ValueError("percent lies in 1 to 100")
    rows = keyed(docs.withColumn(id_col, F.col(f"`{id_col}`").cast("long")), id_col, text_col)
    head = [rows.schema["_id"], *(T.StructField(c, T.LongType()) for c in ("_hash", "n", "one", "two")), T.StructField("counts", T.BinaryType())]
    survey = written(arrow_map(rows, _survey(words), T.StructType(head)), "survey")
    linking = survey.filter("n > 0 and _id is not null")

    parts = arrow_map(rows.filter("_id is not null").select("_text"), _parts(words, percent), "part long, class long")
    lists = parts.repartition("part").sortWithinPartitions("part", "class")
    met = written(arrow_map(lists, _meetings, "part long, class long"), "meetings")
    classes = written(linking.groupBy("one", "two", "n").agg(F.min(F.struct("_id", "_hash")).alias("first")), "classes")
    blocks = components(_blocks(met, linking, percent, meeting))

    chosen = written(
        classes.join(blocks, classes["one"] == blocks["node"]).select(
            F.col("first._id").alias("_id"), F.col("first._hash").alias("_hash"), F.col("component").alias("block"), "n"
        ),
        "chosen",
    )
    heavy = chosen.groupBy("block").agg(F.ceil(F.sum("n") / block_grams).cast("int").alias("parts"))
    chosen = chosen.join(heavy, "block").select("_id", "_hash", "block", "parts")
    wanted = chosen.hint("merge")  # grows with the input: never broadcast
    texts = rows.join(wanted, same_row(rows, wanted)).select(rows["_id"], "_text", "block", "parts").dropDuplicates(["_id", "_text", "block"])
    set_schema = T.StructType([rows.schema["_id"], T.StructField("block", T.LongType()), T.StructField("parts", T.IntegerType()), T.StructField("grams", T.BinaryType())])
    sets = arrow_map(texts, _sets(words), set_schema)
    own = F.pmod(F.xxhash64("_id"), F.col("parts")).cast("int")
    dealt = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("block", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "_id", "grams")
    products = dealt.repartition("block", "i", "j").sortWithinPartitions("block", "i", "j", "_id")
    links = written(arrow_map(products, _multiply(percent), "a long, b long"), "links")

    copies = linking.join(classes, ["one", "two", "n"]).select(F.col("_id").alias("a"), F.col("first._id").alias("b"))
    reach = components(links.unionByName(copies))
    named = survey.join(reach, survey["_id"] == reach["node"], "left")
    return named.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "_id").alias("component_id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, of which one document of each component stays: the smallest id.

    Rows without id stay, and rows that share an id stay or go together; :func:`dedup_rows` goes by row.
    """
    found = similar_components(docs, id_col, text_col, words, percent)
    beaten = written(found.filter(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("_beaten")).distinct(), "beaten")
    return docs.join(beaten, docs[f"`{id_col}`"].cast("long") == beaten["_beaten"], "left_anti")


def dedup_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, with all their columns, exactly one of each component of linked rows.

    A row is linked by its own text, whatever its id and whether it has one. The smallest id stays, a missing id only
    where a component has no other; of rows that share the id, one of least hash. Of rows that repeat both id and text
    one stays. Other rows without words stay. A row goes by a hash of id and text of 64 bits.
    """
    own = F.col(f"`{id_col}`")
    node = F.xxhash64(own, F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    found = similar_components(docs.select(node.alias("doc_id"), F.col(f"`{text_col}`").alias("text")), words=words, percent=percent)
    linked = written(found.filter("component_id <> doc_id").select("doc_id", "component_id").distinct(), "linked")
    members = linked.unionByName(linked.select(F.col("component_id").alias("doc_id"), "component_id").distinct())
    named = written(docs.select(node.alias("node"), own.alias("id")).groupBy("node").agg(F.min("id").alias("id"), F.count("*").alias("n")), "named")
    ranked = written(members.join(named, members["doc_id"] == named["node"]).select("component_id", "node", "id"), "ranked")
    best = ranked.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("missing"), "id", "node")).alias("best"))
    kept = best.select(F.col("best.node").alias("node"))
    beaten = written(ranked.select("node").join(kept, "node", "left_anti").select(F.col("node").alias("_beaten")), "beaten")
    left = docs.join(beaten, node == beaten["_beaten"], "left_anti")
    again = named.filter("n > 1").select(F.col("node").alias("_again"))
    if again.limit(1).count() == 0:
        return left
    once = left.join(again, node == again["_again"], "left_anti")
    return once.unionByName(first_of_each(left.join(again, node == again["_again"], "left_semi"), node, row_hash(docs)))
