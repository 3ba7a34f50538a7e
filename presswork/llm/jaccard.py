"""Exact Jaccard self-join of texts on word shingles, by vertical partitioning.

A global order puts rare shingles first. Two sets of Jaccard similarity t or more share a shingle
among the first ``n - ceil(t n) + 1`` of each, so only those prefixes are indexed. For candidate
pairs the global order is cut into fragments; each fragment gives the overlap of the two sets within
it, and the sum over the fragments is the size of the intersection.

Links are wanted for the classes that they form, so equal sets are one node from the start. Most
posting lists are short: their pairs are counted, and a pair whose count leaves no room for enough
overlap goes no further. Long lists are not expanded into all their pairs: in rounds, a few members
of each are compared with the others, and whatever is linked becomes one class. Lists that still
hold many classes are split by the second shingle that a similar pair must have in common, and the
pairs of those lists that lie in different classes come last. So no link between classes is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presswork.llm.components import connected_components
from presswork.llm.frames import lean, prepare, read, sized, slices
from presswork.llm.words import WIDTH, Words, shingles
from presswork.session import materialize

#: Similarity in hundredths.
PERCENT = 80
FRAGMENTS = 8
#: Bits of the table of approximate shingle counts. It sets the order, hence the speed, and
#: nothing else; any order of the shingles gives the same links.
COUNT_BITS = 23
_PACK = 1 << 31
#: Shingles that a task counts at a time.
_CHUNK = 4_000_000
#: Of these, and of the bins, how many are worked on in one step.
_STEP = 1 << 18
#: Bytes of text that are made into shingles at a time: these take about 30 times as much.
_TEXT_BYTES = 1 << 18
#: Members up to which a posting list is short, and all its pairs are counted.
SHORT = 8
#: Rounds of proposals by a few members per long list, three times as many each time, before the
#: lists are split. They end early once all pairs are no more than a few per entry of the lists.
ROUNDS, LEADERS, FEW = 2, 4, 4
#: Members of different classes beyond which a list is then split by a second shingle.
LONG = 1000
#: Shingles of the prefix, of a set of ``n``.
_INDEXED = f"cast(n - (n * {PERCENT} + 99) div 100 + 1 as int)"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task counts: (bin, n)."""
    total = np.zeros(1 << COUNT_BITS, np.uint32)
    # Of 32 MB at least: less than that, once freed, stays with the worker for all later stages.
    held, waiting = np.empty(max(_CHUNK, 1 << 22), np.uint64), 0

    def add() -> None:
        own = held[:waiting]
        own.sort()
        for low in range(0, waiting, _STEP):
            # The entries of a shingle that occurs twice or more: those like a neighbour.
            some = own[low : low + _STEP]
            again = np.zeros(len(some), bool)
            before = own[max(low - 1, 0) : low + len(some) - 1]
            again[len(some) - len(before) :] = some[len(some) - len(before) :] == before
            after = own[low + 1 : low + len(some) + 1]
            again[: len(after)] |= some[: len(after)] == after
            bins = (some[again] >> np.uint64(64 - COUNT_BITS)).astype(np.int64)
            np.add.at(total, bins, np.uint32(1))

    for _, body, bounds in slices(batches, "text", _TEXT_BYTES):
        values, _ = shingles(Words(body, bounds))
        while len(values):
            some = values[: _CHUNK - waiting]
            held[waiting : waiting + len(some)] = some
            waiting, values = waiting + len(some), values[len(some) :]
            if waiting == _CHUNK:
                add()
                waiting = 0
    if waiting:
        add()
    del held
    for low in range(0, 1 << COUNT_BITS, _STEP):
        part = np.flatnonzero(total[low : low + _STEP]) + low
        if len(part):
            yield pa.RecordBatch.from_arrays(
                [pa.array(part.astype(np.int32)), pa.array(total[part].astype(np.int64))], names=["bin", "n"]
            )


def shingle_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """How often shingles repeat, added up by the top bits of their hash: (bin, n).

    Every text is read. A task counts the shingles of its texts and passes on those that it met at
    least twice, so that the many that occur once do not blur the counts.
    """

    found = df.select(F.col(f"`{text}`").alias("text")).mapInArrow(lean(_counted), "bin int, n long")
    return found.groupBy("bin").agg(F.sum("n").alias("n"))


def _levels(counts: DataFrame) -> np.ndarray:
    """The bins' levels, 0 to 31, as one byte each: a table of fixed size, whatever the corpus."""
    level = F.least(F.ceil(F.log2("n")), F.lit(31)).cast("byte")
    rows = counts.select("bin", level.alias("level")).toArrow()
    table = np.zeros(1 << COUNT_BITS, np.uint8)
    table[np.asarray(rows.column("bin"))] = np.asarray(rows.column("level"))
    return table


def _ordered(values: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Shingles as numbers whose order is the global one: level first, then hash (58 bits)."""
    level = levels[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
    return ((level << np.uint64(58)) | (values >> np.uint64(6))).view(np.int64)


def _prefix(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def shingle_sets(df: DataFrame, levels, key: str, text: str) -> DataFrame:
    """Per row: key, n (size of its set), digest (of the set, null if empty), prefix.

    The prefix holds one shingle more than is indexed, for the lists that are split by a second one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = levels.value
        for rows, body, bounds in slices(batches, "text", _TEXT_BYTES):
            values, limits = shingles(Words(body, bounds))
            values = _ordered(values, table)
            digests, prefixes = [], []
            for low, high in zip(limits[:-1].tolist(), limits[1:].tolist(), strict=True):
                own = np.sort(values[low:high])
                some = high > low
                digests.append(blake2b(own.tobytes(), digest_size=16).digest() if some else None)
                prefixes.append(own[: _prefix(high - low) + 1] if some else own)
            sizes = np.cumsum([0, *map(len, prefixes)], dtype=np.int32)
            flat = pa.array(np.concatenate(prefixes))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column(0),
                    pa.array(np.diff(limits)),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(sizes), flat),
                ],
                names=["key", "n", "digest", "prefix"],
            )

    source = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    return source.mapInArrow(lean(run), "key long, n long, digest binary, prefix array<long>")


def _segments(df: DataFrame, wanted: DataFrame, levels, pivots: list[int], key: str, text: str):
    """The sets of the ``wanted`` classes, cut at the pivots: (cid, fragment, tokens).

    Only the texts of one row per class are read again, and they bring the class along, so the sets
    are shuffled once, to drop repeated rows. The digest tells the row from one that repeats the id
    with another text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, cuts = levels.value, np.array(pivots, np.int64)
        for rows, body, bounds in slices(batches, "text", _TEXT_BYTES):
            values, limits = shingles(Words(body, bounds))
            values = _ordered(values, table)
            cids, fragments, tokens = [], [], []
            named = zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(), strict=True)
            for (cid, digest), low, high in zip(named, limits[:-1].tolist(), limits[1:].tolist(), strict=True):
                own = np.sort(values[low:high])
                if blake2b(own.tobytes(), digest_size=16).digest() != digest:
                    continue
                for k, part in enumerate(np.split(own, np.searchsorted(own, cuts))):
                    if len(part):
                        cids.append(cid)
                        fragments.append(k)
                        tokens.append(part)
            sizes = np.cumsum([0, *map(len, tokens)], dtype=np.int32)
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cids, pa.int64()),
                    pa.array(fragments, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat)),
                ],
                names=["cid", "fragment", "tokens"],
            )

    keys = wanted.select(F.col("min_key").alias("key"), "cid", "digest")
    source = df.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").alias("text"))
    chosen = source.join(sized(keys), "key").select("text", "cid", "digest")
    cut = chosen.mapInArrow(lean(run), "cid long, fragment int, tokens array<long>")
    return cut.dropDuplicates(["cid", "fragment"])  # a row may stand in the input twice


def _enough(most: Column, both: Column) -> Column:
    """Whether an overlap of ``most`` makes sets with ``both`` shingles, added up, similar."""
    return most * (100 + PERCENT) >= PERCENT * both


def _beyond(n: Column) -> Column:
    """Shingles of a set of ``n`` beyond its prefix."""
    return F.ceil(n * PERCENT / 100) - 1


def _short_pairs(lists: DataFrame, entries: DataFrame) -> DataFrame:
    """(a, b, both) of the pairs in short lists that can be similar; ``both`` adds their sizes.

    A pair's overlap is what the prefixes share and, at most, all of one set beyond its prefix. The
    prefixes share what the short lists count, and in long lists as much as the one with fewer entries.
    """
    kept = ["a", "b", "small", "large", "room"]
    two = lists.filter("members = 2").select(
        "a", "b",
        F.least(_n("low"), _n("high")).alias("small"), F.greatest(_n("low"), _n("high")).alias("large"),
        _room(_n("low"), _place("low"), _n("high"), _place("high")).alias("room"),
    )
    short = entries.filter(F.col("members") <= SHORT)
    x, y = (short.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("cid", "n", "place")]) for s in "xy")
    several = x.join(y, "token").filter("x_cid < y_cid").select(
        F.col("x_cid").alias("a"), F.col("y_cid").alias("b"),
        F.least("x_n", "y_n").alias("small"), F.greatest("x_n", "y_n").alias("large"),
        _room(*map(F.col, ("x_n", "x_place", "y_n", "y_place"))).alias("room"),
    )
    counted = (
        two.select(*kept).union(several.select(*kept))
        .filter(F.col("small") * 100 >= PERCENT * F.col("large"))
        .groupBy("a", "b", "small", "large")
        .agg(F.count("*").alias("met"), F.max("room").alias("room"))
        .filter("room")
    )
    both = F.col("small") + F.col("large")
    long = materialize(
        entries.filter(F.col("members") > SHORT).groupBy("cid").agg(F.count("*").alias("entries")), "long-entries"
    )
    long = sized(long)
    more = F.least(F.coalesce("entries_a", F.lit(0)), F.coalesce("entries_b", F.lit(0)))
    return (
        counted.join(long.toDF("a", "entries_a"), "a", "left")
        .join(long.toDF("b", "entries_b"), "b", "left")
        .filter(_enough(F.col("met") + more + _beyond(F.col("large")), both))
        .select("a", "b", both.alias("both"))
    )


def _likely(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """The pairs (a, b, both) of long lists whose prefixes leave room for enough overlap.

    Let a's prefix end before b's in the global order. What a's prefix shares with b lies in b's
    prefix too, so the overlap is what the prefixes share and, at most, all of a beyond its prefix.
    """
    columns = ("cid", "edge", "shared", "others")
    a, b = (members.select(*[F.col(c).alias(f"{s}_{c}") for c in columns]) for s in "ab")
    beyond = F.when(F.col("a_edge") <= F.col("b_edge"), _beyond(F.col("na"))).otherwise(_beyond(F.col("nb")))
    most = F.size(F.array_intersect("a_shared", "b_shared")) + F.least("a_others", "b_others") + beyond
    both = F.col("na") + F.col("nb")
    return (
        pairs.join(a.withColumnRenamed("a_cid", "a"), "a")
        .join(b.withColumnRenamed("b_cid", "b"), "b")
        .filter(_enough(most, both))
        .select("a", "b", both.alias("both"))
    )


def _verified(pairs: DataFrame, segments: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar: overlaps by fragment, added up per pair."""
    left = segments.select(F.col("cid").alias("a"), "fragment", F.col("tokens").alias("ta"))
    right = segments.select(F.col("cid").alias("b"), "fragment", F.col("tokens").alias("tb"))
    overlap = F.size(F.array_intersect("ta", "tb")).cast("long")
    return (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .withColumn("partial", overlap)
        .groupBy("a", "b", "both")
        .agg(F.sum("partial").alias("met"))
        .filter(F.col("met") * 100 >= PERCENT * (F.col("both") - F.col("met")))
        .select("a", "b")
        .distinct()
    )


def _room(na: Column, i: Column, nb: Column, j: Column) -> Column:
    """Whether two sets with a first common shingle at places i and j can be similar.

    Their sizes must be close, and they can share no more than the shorter of the rests that start
    there. A similar pair passes at its first common shingle at least.
    """
    rest = F.least(na - i, nb - j)
    sizes = (na * 100 >= PERCENT * nb) & (nb * 100 >= PERCENT * na)
    return sizes & _enough(rest, na + nb)


def _n(packed: str) -> Column:
    return F.shiftright(packed, 31)


def _place(packed: str) -> Column:
    return F.col(packed) % _PACK


def _star_pairs(lists: DataFrame, turn: int) -> DataFrame:
    """In each posting list a few members, more each turn, with all members of other classes.

    Those lead that stand in the most lists: of the copies of a text, they have few changes of their
    own, and are similar to more of the others than these are among themselves. Hashes tell the rest
    apart, so lists of the same members have the same leaders.
    """
    counts = lists.groupBy("cid").agg(F.count("*").alias("lists"))
    order = Window.partitionBy("token").orderBy(F.desc("lists"), F.xxhash64("cid", F.lit(turn)))
    leaders = (
        lists.join(counts, "cid")
        .withColumn("turn", F.row_number().over(order))
        .filter(F.col("turn") <= LEADERS * 3**turn)
        .select("token", F.struct("cid", "n", "place", "component").alias("leader"))
    )
    first = F.col("cid") < F.col("leader.cid")
    return (
        lists.join(leaders, "token")
        .filter(F.col("component") != F.col("leader.component"))
        .filter(_room(*map(F.col, ("n", "place", "leader.n", "leader.place"))))
        .select(
            F.least("cid", "leader.cid").alias("a"),
            F.greatest("cid", "leader.cid").alias("b"),
            F.when(first, F.col("n")).otherwise(F.col("leader.n")).alias("na"),
            F.when(first, F.col("leader.n")).otherwise(F.col("n")).alias("nb"),
        )
        .distinct()
    )


def _all_pairs(lists: DataFrame) -> DataFrame:
    """All pairs of a posting list in different classes that can be similar."""
    a, b = (
        lists.select("token", *[F.col(c).alias(f"{s}_{c}") for c in ("cid", "n", "place", "component")])
        for s in "ab"
    )
    return (
        a.join(b, "token")
        .filter((F.col("a_cid") < F.col("b_cid")) & (F.col("a_component") != F.col("b_component")))
        .filter(_room(*map(F.col, ("a_n", "a_place", "b_n", "b_place"))))
        .select(
            F.col("a_cid").alias("a"), F.col("b_cid").alias("b"),
            F.col("a_n").alias("na"), F.col("b_n").alias("nb"),
        )
        .distinct()
    )


def _split(lists: DataFrame, classes: DataFrame) -> DataFrame:
    """The lists by a second shingle, which comes after the first in the prefix or next to its end.

    Different sets that are similar share two shingles or more. At least two of them lie within the
    prefix and one shingle more of either set, so a pair meets under its first two.
    """
    after = F.expr(f"slice(prefix, place + 2, greatest({_INDEXED} - place, 0))")
    pairs = lists.join(classes.select("cid", "prefix"), "cid").select(
        "cid", "n", "place", "token", F.explode(after).alias("second")
    )
    return pairs.select(F.xxhash64("token", "second").alias("token"), "cid", "n", "place")


def _bounded(lists: DataFrame, components: DataFrame, classes: DataFrame) -> DataFrame:
    """The open lists, those beyond :data:`LONG` members split."""
    long = lists.groupBy("token").agg(F.count("*").alias("members")).filter(F.col("members") > LONG)
    long = materialize(long, "long-lists")
    if long.isEmpty():
        return lists
    split = materialize(_open_lists(_split(lists.join(sized(long), "token"), classes), components), "split-lists")
    return lists.join(sized(long), "token", "left_anti").unionByName(split)


def _open_lists(lists: DataFrame, components: DataFrame) -> DataFrame:
    """Posting lists with each member's class, without those that lie in one class."""
    current = lists.join(components, "cid")
    mixed = (
        current.groupBy("token")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low < high")
        .select("token")
    )
    return current.join(mixed, "token", "left_semi")


def _few_left(lists: DataFrame) -> bool:
    """Whether the pairs of different classes are few, against the entries of the lists."""
    own = lists.groupBy("token", "component").agg(F.count("*").alias("n"))
    left = own.groupBy("token").agg(
        F.sum("n").alias("all"), F.sum(F.col("n") * F.col("n")).alias("within")
    )
    pairs = (F.col("all") * F.col("all") - F.col("within")) / 2
    row = left.agg(F.sum(pairs).alias("pairs"), F.sum("all").alias("entries")).first()
    return row["pairs"] <= FEW * row["entries"]


def _merged(components: DataFrame, links: DataFrame) -> DataFrame:
    """The classes after the links (a, b): those that a link joins become one."""
    own = components.select(F.col("cid").alias("a"), F.col("component").alias("ca"))
    other = components.select(F.col("cid").alias("b"), F.col("component").alias("cb"))
    between = links.join(own, "a").join(other, "b").select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    joined = connected_components(between).toDF("component", "new")
    return components.join(joined, "component", "left").select(
        "cid", F.coalesce("new", "component").alias("component")
    )


def similarity_classes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: key, n_shingles, component_id.

    ``component_id`` is the smallest key reachable by links, the row's own included. A null or
    empty text, or one of white space only, has an empty set and no links. A row with a null key
    counts its shingles but takes no part in links, and its class is null. Rows that repeat a key
    and a text fall into one class; rows with one key and different texts are different nodes that
    bear the same key.
    """
    spark = df.sparkSession
    levels = spark.sparkContext.broadcast(_levels(shingle_counts(df, text)))
    sets = materialize(shingle_sets(df, levels, key, text), "shingle-sets")
    classes = materialize(
        sets.filter("digest is not null and key is not null")
        .groupBy("digest")
        .agg(F.min("key").alias("min_key"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
        .withColumn("edge", F.expr(f"element_at(prefix, {_INDEXED})"))
        .withColumn("cid", F.monotonically_increasing_id()),
        "shingle-classes",
    )
    # Size and place as one number, so that a hash aggregate gives both entries of a list of two.
    packed = (F.col("n") * _PACK + F.col("place")).alias("packed")
    indexed = F.posexplode(F.expr(f"slice(prefix, 1, {_INDEXED})")).alias("place", "token")
    postings = classes.select("cid", "n", indexed).select("token", "cid", packed)
    shared = materialize(
        postings.groupBy("token")
        .agg(
            F.count("*").alias("members"),
            F.min("cid").alias("a"),
            F.max("cid").alias("b"),
            F.min("packed").alias("low"),
            F.max("packed").alias("high"),
        )
        .filter("members > 1"),
        "shingle-lists",
    )
    several = sized(shared.filter("members > 2").select("token", "members"))
    entries = materialize(
        postings.join(several, "token").select(
            "token", "cid", _n("packed").alias("n"), _place("packed").alias("place"), "members"
        ),
        "list-entries",
    )
    short = F.col("members") <= SHORT
    lists = entries.filter(~short).drop("members")
    twos = shared.filter("members = 2")
    others = (
        twos.select(F.col("a").alias("cid")).union(twos.select("b"))
        .union(entries.filter(short).select("cid"))
        .groupBy("cid").agg(F.count("*").alias("others"))
    )
    members = materialize(
        lists.groupBy("cid").agg(F.collect_list("token").alias("shared"))
        .join(classes.select("cid", "edge"), "cid")
        .join(others, "cid", "left")
        .select("cid", "edge", "shared", F.coalesce("others", F.lit(0)).alias("others")),
        "list-members",
    )
    pivots = shared.approxQuantile("token", [k / FRAGMENTS for k in range(1, FRAGMENTS)], 0.05)
    pivots = sorted({int(p) for p in pivots})

    def verified(likely: DataFrame) -> DataFrame:
        ends = likely.select(F.col("a").alias("cid")).union(likely.select("b")).distinct()
        wanted = materialize(
            classes.select("cid", "digest", "min_key").join(
                sized(materialize(ends, "pair-ends")), "cid", "left_semi"
            ),
            "wanted",
        )
        segments = materialize(_segments(df, wanted, levels, pivots, key, text), "segments")
        return materialize(_verified(likely, segments), "links")

    first = materialize(_short_pairs(shared, entries), "short-pairs")
    ends = first.select(F.col("a").alias("cid")).union(first.select("b")).union(members.select("cid"))
    components = materialize(ends.distinct().select("cid", F.col("cid").alias("component")), "first-classes")
    links = verified(first)
    if not links.isEmpty():
        components = materialize(_merged(components, links), "merged-classes")
    for turn in range(ROUNDS + 1):
        current = materialize(_open_lists(lists, components), "open-lists")
        if current.isEmpty():
            break
        few = _few_left(current)
        if turn == ROUNDS and not few:
            current = _bounded(current, components, classes)
        last = few or turn == ROUNDS
        pairs = _all_pairs(current) if last else _star_pairs(current, turn)
        links = verified(materialize(_likely(pairs, members), "pairs"))
        if not links.isEmpty():
            components = materialize(_merged(components, links), "merged-classes")
        if last:
            break
    keyed = components.join(classes.select("cid", "min_key"), "cid")
    smallest = keyed.groupBy("component").agg(F.min("min_key").alias("component_id"))
    least = keyed.join(smallest, "component").select("cid", "component_id")
    named = (
        classes.select("cid", "digest", "min_key")
        .join(least, "cid", "left")
        .select("digest", F.coalesce("component_id", "min_key").alias("component_id"))
    )
    return sets.join(named, "digest", "left").select(
        F.col("key").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNotNull(), F.coalesce("component_id", "key")).alias("component_id"),
    )


def one_per_class(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, all columns kept: of those with the smallest key, one by digest.

    Rows are told apart by key and text, so rows that repeat a key with different texts are judged
    each for itself; of rows that repeat both, one stays. Rows with a null key stay: they are in no
    class. Of rows with empty sets, which link with nothing, each different text under a key stays.
    An empty table gives an empty one; other columns play no part, whatever their names.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
    number = F.col(f"`{key}`").cast("long").alias("key")
    body = F.col(f"`{text}`")
    mark = F.xxhash64(F.coalesce(F.md5(body), F.lit("null"))).alias("mark")
    rows = df.select(row, number, mark)
    repeated = materialize(
        rows.filter("key is not null").groupBy("key").agg(F.count("*").alias("times")).filter("times > 1"),
        "repeated-keys",
    )
    if repeated.isEmpty():
        named = similarity_classes(df, key, text)
        kept = named.filter(F.col(key) == F.col("component_id")).select(F.col(key).alias("key"))
        chosen = rows.join(sized(materialize(kept, "kept-ids")), "key", "left_semi")
    else:
        # Every different (key, text) gets a number of its own, in the order of keys.
        numbers = rows.filter("key is not null").select("key", "mark").distinct()
        numbers = _numbered(materialize(numbers, "row-marks"))
        bodies = rows.join(numbers, ["key", "mark"]).select("number", F.col(f"row.`{text}`").alias("text"))
        bodies = materialize(bodies.dropDuplicates(["number"]), "numbered-texts")
        named = similarity_classes(bodies, "number", "text").filter("number = component_id")
        wanted = materialize(numbers.join(named.select("number"), "number", "left_semi"), "kept-rows")
        chosen = rows.join(wanted.select("key", "mark"), ["key", "mark"], "left_semi")
        chosen = chosen.dropDuplicates(["key", "mark"])
    return chosen.select("row").unionByName(rows.filter("key is null").select("row")).select("row.*")


def _numbered(marks: DataFrame) -> DataFrame:
    """(key, mark, number): numbers that rise with (key, mark), by a range partitioning."""
    ranged = marks.repartitionByRange("key", "mark").sortWithinPartitions("key", "mark")
    return materialize(ranged.withColumn("number", F.monotonically_increasing_id()), "numbered-marks")


def op10_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of similar documents: doc_id, n_shingles, component_id."""
    prepare(spark)
    return similarity_classes(read(spark, folder, "documents"))
