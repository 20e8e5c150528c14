"""N-gram Jaccard join with vertical partitioning, and its connected components.

Documents with one set of shingles are one set from the start. A global order of shingles
(rare ones first, by a frequency table of fixed size) gives each set a prefix; two sets
that reach the threshold share a shingle of their prefixes. Candidates are taken in two
ways: first near copies meet a few leaders of their shingles, and what links
is contracted; then all pairs of different components that share prefix shingles, enough of
them for the threshold. Around a large group of near copies lie others that are too far from it to link. They
share most shingles with all of the group, and would meet it pair by pair; such a family is
compared by its differences from one of its sets instead, which hardly two of them share.
Overlaps of candidates are counted by vertical partitioning: the shingle order is cut into
fragments, a fragment's overlaps are counted on their own and summed per pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fillscope.scale import cut_lineage

from .components import components
from .text import NON_SPACE, hashed_words, mix, text_slices

WORDS, PERCENT = 5, 75
# Buckets of the frequency table: fixed, whatever the data. They only order shingles.
FREQUENCY_BITS = 16
# Fragments of the shingle order for counting overlaps.
FRAGMENT_BITS = 2
# Sets with this share of their prefix in other sets' prefixes are taken for near copies at first;
# so many of their shingles name leaders, and so many leaders each set meets, by turn.
ALIKE, SKETCH, LEADERS = 0.4, 8, (1, 4, 4)
# A prefix shingle of so many sets is crowded: its sets meet as families.
CROWD = 64
# Bits of the filter that keeps shingles of other sets from moving; a full filter keeps none back.
FILTER_BITS = 24


def shingle_sets(batch: pa.RecordBatch, words: int = WORDS) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a batch with a column text: its number and its distinct shingle hashes, sorted.

    A text of fewer words is one shingle; a text without words has none.
    """
    weights = mix(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)
    for first, stop, data, offsets in text_slices(batch):
        hashes, places = hashed_words(data, offsets, NON_SPACE)
        size = max(len(hashes) - words + 1, 0)
        rolled = np.zeros(size, np.uint64)
        for k in range(words):
            rolled += hashes[k : k + size] * weights[k]
        rolled = mix(rolled)
        for row in range(first, stop):
            a, b = places[row - first], places[row - first + 1]
            if b - a >= words:
                yield row, np.unique(rolled[a : b - words + 1])
            else:
                short = mix((hashes[a:b] * weights[: b - a]).sum(dtype=np.uint64) + np.arange(1, dtype=np.uint64) + np.uint64(b - a))
                yield row, short if b > a else short[:0]


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set of shingles."""
    total = mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def needed(n: int, percent: int) -> int:
    """The least overlap with which a set of n shingles can reach the threshold."""
    return -(-percent * n // 100)


def _texts(docs: DataFrame, key: str, text: str, row: str | None = None) -> DataFrame:
    more = [] if row is None else [docs[row].alias("row")]
    return docs.select(docs[key].cast("long").alias("doc"), docs[text].cast("string").alias("text"), *more)


def document_sets(texts: DataFrame, words: int) -> DataFrame:
    """One row per document: doc, n, set (null for an empty set), and row if ``texts`` has it."""
    more = [f"row {texts.schema['row'].dataType.simpleString()}"] if "row" in texts.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(len(s), set_id(s) if len(s) else None) for _, s in shingle_sets(batch, words)]
            yield pa.record_batch(
                [batch.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.int64()), *batch.columns[2:]],
                names=["doc", "n", "set", *batch.schema.names[2:]],
            )

    return texts.mapInArrow(run, ", ".join(["doc bigint, n bigint, set bigint", *more]))


def _bucket(shingles: np.ndarray) -> np.ndarray:
    return (shingles >> np.uint64(64 - FREQUENCY_BITS)).astype(np.int64)


def _bucket_counts(sets: list[np.ndarray]) -> np.ndarray:
    return np.bincount(_bucket(np.concatenate(sets)), minlength=1 << FREQUENCY_BITS)


def frequencies(texts: DataFrame, words: int) -> np.ndarray:
    """How many shingles of all documents fall into each bucket; an array of fixed size."""
    size = 1 << FREQUENCY_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            held: list[np.ndarray] = []
            waiting = 0
            for _, shingles in shingle_sets(batch, words):
                held.append(shingles)
                waiting += len(shingles)
                if waiting > 1 << 20:
                    counts += _bucket_counts(held)
                    held, waiting = [], 0
            if held:
                counts += _bucket_counts(held)
        used = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(used.astype(np.int32)), pa.array(counts[used])], names=["bucket", "n"])

    sums = texts.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toArrow()
    counts = np.zeros(size, np.int64)
    counts[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return counts


def prefixes(texts: DataFrame, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """Rows (shingle, set, n) of each set's prefix; a set's rows may repeat."""
    shared = texts.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency, seen = shared.value, set()
        for batch in batches:
            shingles, sets, sizes = [], [], []
            for _, found in shingle_sets(batch, words):
                n = len(found)
                if not n or (name := set_id(found)) in seen:
                    continue
                seen.add(name)
                order = np.argsort(frequency[_bucket(found)], kind="stable")
                shingles.append(found[order[: n - needed(n, percent) + 1]])
                sets.append(name)
                sizes.append(n)
            if sets:
                repeat = [len(s) for s in shingles]
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(shingles).view(np.int64)),
                        pa.array(np.repeat(np.array(sets, np.int64), repeat)),
                        pa.array(np.repeat(np.array(sizes, np.int32), repeat)),
                    ],
                    names=["shingle", "set", "n"],
                )

    return texts.mapInArrow(run, "shingle bigint, set bigint, n int")


def fragments(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """Rows (set, fragment, shingles) of the sets in ``wanted`` (set, doc), from that document's text.

    A filter of fixed size, made from ``wanted``, keeps most other documents from
    emitting rows; the join removes the rest.
    """

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = _slots(batch.column("set"), batch.column("doc"))
            yield pa.record_batch([pa.array(where >> 6), pa.array(np.int64(1) << (where & 63))], names=["word", "bit"])

    found = wanted.select("set", "doc").mapInArrow(bits, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = shared.value
        for batch in batches:
            names, parts, rows = [], [], []
            for row, shingles in shingle_sets(batch, words):
                if not len(shingles):
                    continue
                name = set_id(shingles)
                slot = int(_slots(pa.array([name], pa.int64()), batch.column(0).slice(row, 1))[0])
                if not mask[slot >> 6] >> (slot & 63) & 1:
                    continue
                part = shingles >> np.uint64(64 - FRAGMENT_BITS)
                cuts = np.searchsorted(part, np.arange((1 << FRAGMENT_BITS) + 1, dtype=np.uint64))
                for k in range(1 << FRAGMENT_BITS):
                    if cuts[k] < cuts[k + 1]:
                        names.append(name)
                        parts.append(k)
                        rows.append(shingles[cuts[k] : cuts[k + 1]].view(np.int64))
            yield pa.record_batch(
                [pa.array(names, pa.int64()), pa.array(parts, pa.int32()), pa.array(rows, pa.list_(pa.int64()))],
                names=["set", "fragment", "shingles"],
            )

    emitted = texts.mapInArrow(run, "set bigint, fragment int, shingles array<bigint>")
    # A repeated row of the same document would count twice.
    return emitted.groupBy("set", "fragment").agg(F.first("shingles").alias("shingles")).join(wanted.select("set").distinct(), "set", "left_semi")


def _slots(sets: pa.Array, docs: pa.Array) -> np.ndarray:
    """The filter bit of each (set, document)."""
    a, b = (x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64) for x in (sets, docs))
    return (mix(a ^ mix(b + np.uint64(1))) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def links(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b, na, nb; distinct) that reach the threshold: a, b.

    Overlaps are counted per fragment and summed per pair.
    """
    left = parts.select(F.col("set").alias("a"), "fragment", F.col("shingles").alias("of_a"))
    right = parts.select(F.col("set").alias("b"), "fragment", F.col("shingles").alias("of_b"))
    counted = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("of_a", "of_b")).alias("both"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("both").alias("both"))
    )
    return counted.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * percent).select("a", "b")


def _possible(a: str, b: str, percent: int):
    """Sizes of two sets that can reach the threshold."""
    return (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)


def _enough(both, na, nb, percent: int):
    """Whether sets of sizes na and nb whose prefixes share ``both`` shingles can reach the threshold.

    They share these, and at most all that is left of one set behind its prefix.
    """
    spare = F.greatest(*[F.ceil(n * percent / 100) - 1 for n in (na, nb)])
    return (both + spare) * (100 + percent) >= (na + nb) * percent


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """One row per document: key, n_shingles, component_id.

    A document's set holds its distinct shingles of ``words`` words between ASCII white space, A-Z in
    lower case; with fewer words the whole sequence. Documents link when
    100 * intersection >= percent * union; component_id is the smallest key reachable.
    Null and empty texts and texts without words have no shingles and are their own
    component. Repeated rows give a row each. Rows with a null key belong to their component; if
    all its keys are null, component_id is null. Shingles and sets are named by 64-bit hashes.
    """
    members, named_sets = _grouped(_texts(docs, key, text), words, percent)
    smallest = named_sets.groupBy("c").agg(F.min("doc").alias("component"))
    classes = named_sets.join(smallest, "c").select("set", "component")
    return members.join(classes, "set", "left").select(
        F.col("doc").alias(key), F.col("n").alias("n_shingles"), F.when(F.col("set").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component_id")
    )


def surplus_rows(
    docs: DataFrame, row: str, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The values of column ``row``, one per row of ``docs``, of all rows but one of each component.

    Components are those of ``near_duplicates``; the row with the smallest key stays, rows without
    a key come last, of equal keys the smallest ``row`` stays. Rows without shingles are never surplus.
    """
    members, named_sets = _grouped(_texts(docs, key, text, row), words, percent)
    # Copies are brought to one row per set before the join, so that no large group is one key.
    first = F.min(F.struct(F.col("doc").isNull().alias("nameless"), "doc", "row")).alias("first")
    held = members.where("set is not null")
    stays = held.groupBy("set").agg(first).join(named_sets.select("set", "c"), "set").groupBy("c").agg(F.min("first").alias("first"))
    return held.select("row").join(stays.select("first.row"), "row", "left_anti").withColumnRenamed("row", row)


def _grouped(texts: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc, n, set, and row if given) of the documents, and (set, doc, c) of the sets: smallest document, component."""
    members = cut_lineage(document_sets(texts, words))
    sets = members.where("set is not null").groupBy("set").agg(F.min("doc").alias("doc"))
    prefix = prefixes(texts, frequencies(texts, words), words, percent)
    # Shingles that one set alone holds link nothing; most go here.
    # One shuffle by shingle serves the distinct rows and the window.
    held = prefix.repartition("shingle").groupBy("shingle", "set").agg(F.max("n").alias("n"))
    by_shingle = W.partitionBy("shingle")
    postings = cut_lineage(
        held.withColumns({"leader": F.min("set").over(by_shingle), "last": F.max("set").over(by_shingle)})
        .where("leader != last")
        .select("shingle", "set", "n")
    )
    found, labels, parts = _star_links(texts, sets, postings, words, percent)

    # All pairs of different components that share prefix shingles.
    named = postings.join(labels.withColumnsRenamed({"node": "set", "component": "c"}), "set", "left").select(
        "shingle", "set", "n", F.coalesce("c", "set").alias("c")
    )
    named = cut_lineage(_able(_mixed(named, "c"), percent))
    family = _families(named, parts)
    inside, centred = _pairs_in_families(family, parts, percent)
    # Families are done; for the others a component is a group of its own.
    grouped = named.join(family.select("set", "f"), "set", "left").select(
        "shingle", "set", "n", "c", "shared", F.struct(F.col("f").isNotNull().alias("family"), F.coalesce("f", "c").alias("name")).alias("g")
    )
    mixed = cut_lineage(_mixed(grouped, "g").drop("rows", "low", "high"))
    second = (
        _met_by_shingle(mixed, percent)
        .groupBy("a", "b", "na", "nb")
        .agg(F.count(F.lit(1)).alias("both"))
        .where(_enough(F.col("both"), F.col("na"), F.col("nb"), percent))
    )
    found = found.union(centred)
    second = second.union(inside)
    second = cut_lineage(second)
    # The partner with most in common comes first, on either side; who links with it needs no other
    # partner in that component. Then all pairs of what are still different components.
    whole = F.struct("both", "a", "b", "na", "nb")
    best = [second.groupBy(side).agg(F.max(whole).alias("best")).select("best.a", "best.b", "best.na", "best.nb") for side in ("a", "b")]
    nearest = cut_lineage(best[0].union(best[1]).distinct())
    # Every set of a pair is in one of its nearest pairs.
    wanted = sets.join(nearest.select(F.col("a").alias("set")).union(nearest.select("b")).distinct(), "set", "left_semi")
    parts = cut_lineage(fragments(texts, cut_lineage(wanted), words))
    found = found.union(cut_lineage(links(nearest, parts, percent)))
    labels = components(found)
    sides = [labels.select(F.col("node").alias(s), F.col("component").alias("c" + s)) for s in ("a", "b")]
    apart = F.coalesce("ca", "a") != F.coalesce("cb", "b")
    rest = second.join(sides[0], "a", "left").join(sides[1], "b", "left").where(apart).select("a", "b", "na", "nb")
    rest = cut_lineage(rest.join(nearest.select("a", "b"), ["a", "b"], "left_anti"))
    more = cut_lineage(links(rest, parts, percent))
    labels = components(found.union(more))

    named_sets = sets.join(labels.withColumnsRenamed({"node": "set", "component": "c"}), "set", "left").select(
        "set", "doc", F.coalesce("c", "set").alias("c")
    )
    return members, named_sets


def _star_links(texts: DataFrame, sets: DataFrame, postings: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of sets to leaders, the components they make, and the fragments of the sets that met leaders.

    This spares the pairs within groups of near copies: sets with mostly shared prefixes meet a
    few leaders of some of their shingles (those first in hash order), in turns with
    other leaders for what has not linked yet. What is missed here is found afterwards.
    """
    alike = (
        postings.groupBy("set", "n")
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") >= ALIKE * (F.col("n") - F.ceil(F.col("n") * percent / 100) + 1))
        .select("set")
    )
    alike = cut_lineage(sets.join(alike, "set"))
    order = W.partitionBy("set").orderBy(F.xxhash64("shingle"))
    some = postings.join(alike.select("set"), "set", "left_semi").withColumn("k", F.row_number().over(order))
    some = cut_lineage(some.where(F.col("k") <= SKETCH).select("shingle", "set", "n"))
    parts = cut_lineage(fragments(texts, alike, words))
    found = labels = None
    for turn, leaders in enumerate(LEADERS):
        named = some.withColumn("c", F.col("set"))
        if labels is not None:
            known = labels.withColumnsRenamed({"node": "set", "component": "c"})
            named = some.join(known, "set", "left").withColumn("c", F.coalesce("c", "set"))
        ranks = [F.xxhash64("set", F.lit(100 * turn + k)) for k in range(leaders)]
        chosen = (
            named.groupBy("shingle")
            .agg(F.array(*[F.min(F.struct(r.alias("r"), "set", "n", "c")) for r in ranks]).alias("led"), F.min("c").alias("low"), F.max("c").alias("high"))
            .where("low != high")
            .select("shingle", F.posexplode("led").alias("k", "leader"))
        )
        pairs = (
            named.join(chosen, "shingle")
            .select(F.col("set").alias("a"), F.col("n").alias("na"), "c", "k", F.col("leader.set").alias("b"), F.col("leader.n").alias("nb"), F.col("leader.c").alias("cb"))
            .where((F.col("c") != F.col("cb")) & _possible("na", "nb", percent))
            .groupBy("a", "na", "k", "b", "nb")
            .agg(F.count(F.lit(1)).alias("both"))
            .groupBy("a", "na", "k")
            .agg(F.max(F.struct("both", "b", "nb")).alias("best"))
            .select("a", F.col("best.b").alias("b"), "na", F.col("best.nb").alias("nb"))
            .distinct()
        )
        fresh = cut_lineage(links(pairs, parts, percent))
        found = fresh if found is None else found.union(fresh)
        labels = components(found)
    return found, labels, parts


def _in_order() -> list:
    """Columns a, b, na, nb with the smaller set first."""
    first = F.col("a") < F.col("b")
    return [
        F.least("a", "b").alias("a"),
        F.greatest("a", "b").alias("b"),
        F.when(first, F.col("na")).otherwise(F.col("nb")).alias("na"),
        F.when(first, F.col("nb")).otherwise(F.col("na")).alias("nb"),
    ]


def _mixed(postings: DataFrame, group: str) -> DataFrame:
    """The rows whose shingle several groups hold, with its largest group (most), number of sets (rows) and their sizes (low, high)."""
    sizes = postings.groupBy("shingle", group).agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("low"), F.max("n").alias("high"))
    held = (
        sizes.groupBy("shingle")
        .agg(
            F.count(F.lit(1)).alias("groups"), F.sum("size").alias("rows"), F.max(F.struct("size", group)).alias("most"),
            F.min("low").alias("low"), F.max("high").alias("high"),
        )
        .where("groups > 1")
    )
    return postings.join(held.select("shingle", F.col(f"most.{group}").alias("most"), "rows", "low", "high"), "shingle")


def _able(mixed: DataFrame, percent: int) -> DataFrame:
    """The rows of ``mixed`` that may serve a pair, with the number of rows of their set (shared).

    Sets of sizes near each other must share a good part of their prefixes. A set with fewer rows can reach
    only sets much smaller or larger, and leaves the shingles that have none of these.
    """
    counts = mixed.groupBy("set").agg(F.count(F.lit(1)).alias("shared"))
    # Without the rounding of _enough, the demand falls steadily towards both ends of the sizes.
    ends = [
        (100 * F.col("shared") + percent * F.greatest("n", end)) * (100 + percent) >= 100 * percent * (F.col("n") + F.col(end)) for end in ("low", "high")
    ]
    return mixed.join(counts, "set").where(ends[0] | ends[1]).drop("low", "high")


def _met_by_shingle(mixed: DataFrame, percent: int) -> DataFrame:
    """A row (a, b, na, nb) for each shingle of ``mixed`` that two sets of different groups and components share."""
    # Only the rows outside a shingle's largest group look for partners.
    few, all_ = [
        mixed.select("shingle", *[F.col(x).alias(y) for x, y in zip(("set", "n", "c", "g", "shared"), names)], "most")
        for names in (("a", "na", "ca", "ga", "shared_a"), ("b", "nb", "cb", "gb", "shared_b"))
    ]
    few = few.where("ga != most").drop("most")
    apart = (F.col("ga") != F.col("gb")) & (F.col("ca") != F.col("cb")) & _possible("na", "nb", percent)
    able = _enough(F.least("shared_a", "shared_b"), F.col("na"), F.col("nb"), percent)
    return (
        few.join(all_, "shingle")
        .where(apart & able & ((F.col("gb") == F.col("most")) | (F.col("a") < F.col("b"))))
        .select(*_in_order())
    )


def _families(named: DataFrame, parts: DataFrame) -> DataFrame:
    """Rows (set, n, c, f) of the sets with fragments that hold crowded shingles: f is the component these mostly belong to.

    Only families of several components are kept. Any choice of families is right; this one keeps
    differences small.
    """
    votes = named.where(F.col("rows") >= CROWD).groupBy("set", "n", "c", "most").agg(F.count(F.lit(1)).alias("votes"))
    chosen = votes.groupBy("set", "n", "c").agg(F.max(F.struct("votes", "most")).alias("best")).select("set", "n", "c", F.col("best.most").alias("f"))
    chosen = cut_lineage(chosen.join(parts.select("set").distinct(), "set", "left_semi"))
    several = chosen.groupBy("f").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low != high").select("f")
    return cut_lineage(chosen.join(several, "f").select("set", "n", "c", "f"))


def _met_by_difference(sought: DataFrame, taken: DataFrame, percent: int) -> DataFrame:
    """A row for each element of ``taken`` (of sets b) that a set a of another component seeks in the same family.

    ``left_a`` and ``left_b`` count a set's elements from this one on in one order of all. The first element
    that two sets share leaves both enough for all that they must share.
    """
    once = ~F.col("back") | (F.col("sa") > F.col("sb")) | ((F.col("sa") == F.col("sb")) & (F.col("a") > F.col("b")))
    able = 2 * (100 + percent) * F.least("left_a", "left_b") >= F.col("sa") + F.col("sb")
    return sought.join(taken, ["f", "shingle"]).where((F.col("ca") != F.col("cb")) & once & able & _possible("na", "nb", percent))


def _pairs_in_families(family: DataFrame, parts: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Candidates (a, b, na, nb, both) of different components in one family, and the links (a, b) to the families' centres.

    Let D(x) be the difference of x from the centre, d(x) its size, and S(x) = (100 + percent) d(x) - (100 - percent) n(x).
    Two sets link when 2 (100 + percent) |D(o) & D(x)| >= S(o) + S(x). A set o that
    does not link with the centre has S(o) > (100 - percent) n(centre), so what x must share with it is more than
    about half of D(x): o finds x by an element early in D(x), where those come first that the fewest such
    sets have. Of two sets of different components one at least does not link with the
    centre; if neither does, the one with the larger S finds the other.
    """
    parts = cut_lineage(parts.join(family.select("set"), "set", "left_semi"))
    # The centre is the set closest to all others, by one fragment.
    rows = family.join(parts.where("fragment = 0"), "set").select("f", "set", F.explode("shingles").alias("shingle"))
    holders = rows.groupBy("f", "shingle").agg(F.count(F.lit(1)).alias("holders"))
    sizes = family.groupBy("f").agg(F.count(F.lit(1)).alias("size"))
    sums = rows.join(holders, ["f", "shingle"]).groupBy("set").agg(F.sum("holders").alias("held"), F.count(F.lit(1)).alias("own"))
    centres = (
        family.join(sums, "set", "left")
        .join(sizes, "f")
        .withColumn("gain", 2 * F.col("held") - F.col("size") * F.col("own"))
        .groupBy("f")
        .agg(F.max(F.struct(F.coalesce("gain", F.lit(0)).alias("gain"), "set", "n", "c")).alias("centre"))
        .select("f", F.col("centre.set").alias("centre"), F.col("centre.n").alias("n_centre"), F.col("centre.c").alias("c_centre"))
    )
    centres = cut_lineage(centres)

    every = F.explode(F.sequence(F.lit(0), F.lit((1 << FRAGMENT_BITS) - 1))).alias("fragment")
    of_centre = centres.select("f", F.col("centre").alias("set")).join(parts, "set").select("f", "fragment", F.col("shingles").alias("of_centre"))
    none = F.array().cast("array<bigint>")
    differences = (
        family.join(centres, "f")
        .select("*", every)
        .join(parts, ["set", "fragment"], "left")
        .join(of_centre, ["f", "fragment"], "left")
        .withColumns({"shingles": F.coalesce("shingles", none), "of_centre": F.coalesce("of_centre", none)})
        .select(
            "f", "set", "n", "c", "centre", "n_centre", "c_centre",
            F.concat(F.array_except("shingles", "of_centre"), F.array_except("of_centre", "shingles")).alias("apart"),
        )
    )
    differences = cut_lineage(differences)
    scale = 100 + percent
    distances = differences.groupBy("f", "set", "n", "c", "centre", "n_centre", "c_centre").agg(F.sum(F.size("apart")).alias("d"))
    distances = distances.withColumn("s", scale * F.col("d") - (100 - percent) * F.col("n"))
    limit = (100 - percent) * F.col("n_centre")
    beyond = F.col("s") - limit
    seeks = (F.col("c") != F.col("c_centre")) & (beyond > 0)
    other = F.when(seeks, F.col("s")).otherwise(limit + 1)
    distances = cut_lineage(distances.withColumns({"seeks": seeks, "least": F.ceil((F.col("s") + other) / (2 * scale))}))
    centred = distances.where((F.col("c") != F.col("c_centre")) & (beyond <= 0)).select(F.col("set").alias("a"), F.col("centre").alias("b"))
    centred = cut_lineage(centred)

    elements = differences.select("set", F.explode("apart").alias("shingle"))
    sought = elements.join(distances.where("seeks").select("f", "set", "n", "c", "s"), "set")
    sought = cut_lineage(sought.select("f", "shingle", *[F.col(x).alias(y) for x, y in zip(("set", "n", "c", "s"), ("a", "na", "ca", "sa"))]))
    known = cut_lineage(sought.groupBy("f", "shingle").agg(F.count(F.lit(1)).alias("known")))
    backward = [F.col("known").desc(), F.col("shingle").desc()]
    # An element of no other seeker finds nobody.
    taken = (
        elements.join(distances, "set")
        .join(known, ["f", "shingle"])
        .where(F.col("known") > F.col("seeks").cast("int"))
        .withColumn("left_b", F.row_number().over(W.partitionBy("set").orderBy(*backward)))
        .where("left_b >= least")
        .select("f", "shingle", F.col("set").alias("b"), F.col("n").alias("nb"), F.col("c").alias("cb"), F.col("s").alias("sb"), F.col("seeks").alias("back"), "left_b")
    )
    sought = sought.join(known, ["f", "shingle"]).withColumn("left_a", F.row_number().over(W.partitionBy("a").orderBy(*backward))).drop("known")
    pairs = _met_by_difference(sought, taken, percent).select(*_in_order())
    inside = pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("both"))
    return cut_lineage(inside), centred
