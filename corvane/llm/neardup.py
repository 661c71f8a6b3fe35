"""Near duplicates by SetSketch: exponentially spaced truncated minima, banded, jointly estimated, verified.

A document's set is its distinct word shingles, as 64-bit hashes. Register i of its sketch is
``floor(1 - log_b x_i)`` clipped to [0, q + 1], where x_i is the least of the shingles' exponential
hashes for i. Registers of a union are the larger of the two, so sketches are mergeable, and
registers of similar sets agree with about their Jaccard similarity.

1. Documents with equal sets are one class from the start (a group by the set's 128-bit digest).
2. Bands of registers are hashed into buckets. In a bucket of classes, each member is compared with
   one leader, not with every member: first the one that meets most others. Compared means: the joint likelihood of both sketches, whose
   set sizes are known, gives an estimate of the similarity; pairs less than five standard errors
   below the threshold are verified on their full sets. Links are contracted to components.
3. That is repeated with random leaders for the buckets that still hold several components.
4. What is left are members of buckets that still hold several components. From large buckets an exact
   prefix filter on rare shingles takes out those that cannot be linked beyond their component: sets of
   sizes n and m that reach the similarity have o = 0.8 / 1.8 * (n + m) shingles in common, so of both,
   in one order of all shingles, the first n - o + 1 and m - o + 1 share one. The rarest come first, and
   before them those that only one component has, which use up places and match nothing. So texts that
   differ from their family in more than a ninth of their shingles go, however many they are, by a
   count, a join on shingles and a grouped sum.
5. Those who stay are compared completely: all members of different components that share a bucket,
   in blocks of registers, so that no pair is left out and no list of all pairs is made. Large buckets
   are cut into blocks that are dealt over tasks.

So every pair that shares a band of registers is either in one component, ruled out or compared. A pair
at the threshold shares no band with a probability of ``(1 - 0.8**5)**36``, less than one in a million.
Nothing per document goes to the driver; every table between the steps lies in the shared folder.
Counts and leaders of buckets are written before they are joined to the members, so that the planner
can broadcast few of them and split the members of a hot bucket over tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BINARY, LONG, Scratch, few_of, mapped, schema
from .components import components

WORDS, PERCENT = 5, 80
BANDS, ROWS = 36, 5
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 2  # b, a and q of the sketch: two bytes a register
BLOCK = 256  # classes of a block; a group of rows holds two
ERRORS = 5.0  # standard errors below the threshold at which an estimate rules a pair out
CLASSES = 16  # of set sizes, an octave
LEADER_ROUNDS = 2  # the first with the member that meets most others as leader, then with random ones
_MEMORY = 200_000  # word hashes remembered in a worker

_MIX = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.random.Generator(np.random.PCG64(11)).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFT = np.random.Generator(np.random.PCG64(13)).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _scrambled(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(text: str | None, words: int, hashes: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles: A-Z lower-cased, words between ASCII white space."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, found), np.uint64, n)
    k = min(words, n)
    rows = n - k + 1
    total = np.full(rows, k, np.uint64)
    for i in range(k):
        total += h[i : i + rows] * _MIX[i]
    return np.unique(_scrambled(total))


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a non-empty set, as 16-bit numbers."""
    least = np.full(len(_STEP), np.iinfo(np.uint64).max, np.uint64)
    room = np.empty((min(256, len(shingles)), len(_STEP)), np.uint64)  # small enough for a core's cache
    for at in range(0, len(shingles), 256):
        some = shingles[at : at + 256, None]
        h = room[: len(some)]
        np.bitwise_xor(some, _SHIFT, out=h)
        np.multiply(h, _STEP, out=h)
        np.minimum(least, h.min(0), out=least)
    uniform = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(uniform, 1 - 1e-16)) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, TOP + 1).astype("<u2")


def likely_similarity(equal: np.ndarray, more: np.ndarray, less: np.ndarray, n: np.ndarray, m: np.ndarray, base: float = BASE) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sets with sizes n and m.

    equal, more, less: how many registers of the first sketch equal, exceed, fall below the second's.
    The log-likelihood is concave in the similarity, so its derivative's zero is found by bisection.
    """
    u, v = n / (n + m), m / (n + m)
    scale, log_base = (base - 1) / base, np.log(base)
    low, high = np.zeros(len(u)), np.minimum(u / v, v / u) * (1 - 1e-12)

    def p(x):
        return -np.log1p(-x * scale) / log_base

    def slope(x):
        return scale / (1 - x * scale) / log_base

    for _ in range(30):
        j = (low + high) / 2
        a, b = np.maximum(u - v * j, 1e-15), np.maximum(v - u * j, 1e-15)
        da, db = -v * slope(a), -u * slope(b)
        gradient = more * da / p(a) + less * db / p(b) - equal * (da + db) / np.maximum(1 - p(a) - p(b), 1e-15)
        low, high = np.where(gradient > 0, j, low), np.where(gradient > 0, high, j)
    return (low + high) / 2


def _least_estimate(percent: int) -> float:
    j = percent / 100
    return j - ERRORS * (j * (1 - j) / (BANDS * ROWS)) ** 0.5


SKETCH = schema(doc_id=LONG, n=LONG, digest=BINARY, regs=BINARY)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n (size of the set), digest of the set, registers; digest and registers null for empty sets."""

    def work(frames):
        import xxhash

        hashes = WordHashes()
        for frame in frames:
            n, digest, regs = [], [], []
            for text in frame.column("text").to_pylist():
                s = shingle_set(text, words, hashes)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
                if len(hashes) > _MEMORY:
                    hashes.clear()
            yield pa.RecordBatch.from_arrays([frame.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(regs, pa.binary())], names=SKETCH.names)

    return mapped(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), work, SKETCH)


def _band_keys() -> F.Column:
    width = 2 * ROWS
    return F.array(*[F.xxhash64(F.lit(i), F.substring("regs", 1 + i * width, width)) for i in range(BANDS)])


SETS = schema(id=LONG, shingles=T.ArrayType(LONG))


def _full_sets(docs: DataFrame, ids: DataFrame, words: int, n: int | None = None) -> DataFrame:
    """id and shingle hashes of the documents with these ids, a written table of ``n`` rows."""

    def work(frames):
        hashes = WordHashes()
        for frame in frames:
            sets = []
            for text in frame.column("text").to_pylist():
                sets.append(shingle_set(text, words, hashes).view(np.int64))
                if len(hashes) > _MEMORY:
                    hashes.clear()
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([frame.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))], names=SETS.names)

    whole = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return mapped((whole if n is None else few_of(whole, "id", ids, n)).join(ids, "id", "left_semi"), work, SETS)


PAIRS = schema(a=LONG, b=LONG)


def _estimated(pairs: DataFrame, sketch: DataFrame, percent: int) -> DataFrame:
    """The pairs that their sketches don't rule out."""
    one = sketch.select(F.col("rep").alias("a"), F.col("n").alias("n_a"), F.col("regs").alias("r_a"))
    two = sketch.select(F.col("rep").alias("b"), F.col("n").alias("n_b"), F.col("regs").alias("r_b"))
    joined = pairs.join(one, "a").join(two, "b").where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
    least = _least_estimate(percent)

    def work(frames):
        for frame in frames:
            if frame.num_rows:
                r, s = (np.frombuffer(b"".join(frame.column(c).to_pylist()), "<u2").reshape(frame.num_rows, -1) for c in ("r_a", "r_b"))
                n, m = (frame.column(c).to_numpy().astype(float) for c in ("n_a", "n_b"))
                keep = likely_similarity((r == s).sum(1), (r > s).sum(1), (r < s).sum(1), n, m) >= least
                yield pa.RecordBatch.from_arrays([frame.column(c).filter(pa.array(keep)) for c in PAIRS.names], names=PAIRS.names)

    return mapped(joined.select("a", "b", "n_a", "n_b", "r_a", "r_b"), work, PAIRS)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("s_a"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("s_b"))
    both = F.size(F.array_intersect("s_a", "s_b"))
    union = F.size("s_a") + F.size("s_b") - F.col("both")
    return pairs.join(one, "a").join(two, "b").withColumn("both", both).where(F.col("both") * 100 >= union * percent).select("a", "b")


def _pairs_in_group(rep, comp, block, same, band, n, regs, least: float):
    """Indices of the pairs of different components that this bucket has to compare and the sketches don't rule out.

    A pair that shares several bands is compared in the first of them only.
    """
    bands = regs.reshape(len(rep), BANDS, ROWS)
    for at in range(0, len(rep), 64):
        r = regs[at : at + 64, None, :]
        equal = (r == regs).sum(2)
        wanted = (comp[at : at + 64, None] != comp) & (rep[at : at + 64, None] < rep) & (equal >= (least - 0.1) * regs.shape[1])
        if not same.any():  # two blocks meet: pairs within one are compared elsewhere
            wanted &= block[at : at + 64, None] != block
        i, j = np.nonzero(wanted)
        first = (bands[at + i] == bands[j]).all(2).argmax(1) == band[0]
        i, j = i[first], j[first]
        e, g = equal[i, j], (regs[at + i] > regs[j]).sum(1)
        keep = likely_similarity(e, g, regs.shape[1] - e - g, n[at + i], n[j]) >= least
        yield at + i[keep], j[keep]


def _by_group(frames, columns: list[str]):
    """Rows of sorted frames, a group at a time, as lists of arrays; a group may run over several frames."""
    held, last = [], None
    for frame in frames:
        group = frame.column("group").to_numpy()
        if not len(group):
            continue
        data = [np.frombuffer(b"".join(frame.column(c).to_pylist()), "<u2").reshape(len(group), -1) if c == "regs" else np.array([np.asarray(x) for x in frame.column(c).to_pylist()] + [None], object)[:-1] if c == "shingles" else frame.column(c).to_numpy(zero_copy_only=False) for c in columns]
        starts = [0, *(np.flatnonzero(group[1:] != group[:-1]) + 1).tolist(), len(group)]
        for s, e in zip(starts, starts[1:]):
            if last is not None and group[s] != last:
                yield last, [np.concatenate(x) for x in zip(*held)]
                held = []
            held.append([c[s:e] for c in data])
            last = group[s]
    if held:
        yield last, [np.concatenate(x) for x in zip(*held)]


def _blocks_compared(members: DataFrame, sketch: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """Links between members of different components in a bucket; members: key, band, rep, comp.

    Members of a bucket's largest component need not be compared with each other. The others are cut
    into blocks of about BLOCK, and so is that component; each block of the others meets each block in
    one group of rows, which holds some 2 * BLOCK rows at most, however large the bucket is. A first pass
    over the sketches tells which members have a pair to verify; a second one gets only their full sets,
    and verifies where the group lies, so pairs that are no links never leave it.
    """
    counts = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    in_blocks = lambda c: F.ceil(c / BLOCK).cast("int")
    sizes = scratch.keep(counts.groupBy("key").agg(F.max_by("comp", F.struct("c", "comp")).alias("largest"), in_blocks(F.sum("c") - F.max("c")).alias("others"), in_blocks(F.max("c")).alias("blocks")))
    outer, of = F.col("comp") != F.col("largest"), F.xxhash64("rep")
    block = F.when(outer, F.pmod(of, F.col("others"))).otherwise(F.col("others") + F.pmod(of, F.col("blocks"))).cast("int")
    last = F.when(outer, F.col("others") + F.col("blocks")).otherwise(F.col("others")) - 1
    met = members.join(sizes, "key").select("key", "band", "rep", "comp", block.alias("block"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    groups = met.select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("group"), "band", "rep", "comp", "block", (F.col("block") == F.col("other")).alias("same"))
    least, first = _least_estimate(percent), ["rep", "comp", "block", "same", "band", "n", "regs"]

    def likely(frames):
        for group, (rep, comp, block, same, band, n, regs) in _by_group(frames, first):
            found = np.zeros(len(rep), bool)
            for i, j in _pairs_in_group(rep, comp, block, same, band, n.astype(float), regs, least) if len(rep) > 1 else ():
                found[i] = found[j] = True
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(found.sum(), group)), pa.array(rep[found])], names=["group", "rep"])

    def exact(frames):
        for _, (rep, comp, block, same, band, n, regs, shingles) in _by_group(frames, [*first, "shingles"]):
            links = []
            for i, j in _pairs_in_group(rep, comp, block, same, band, n.astype(float), regs, least) if len(rep) > 1 else ():
                for x, y in zip(i.tolist(), j.tolist()):
                    both = len(np.intersect1d(shingles[x], shingles[y], assume_unique=True))
                    if both * 100 >= (n[x] + n[y] - both) * percent:
                        links.append((rep[x], rep[y]))
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], names=PAIRS.names)

    shaped = groups.join(sketch, "rep").select("group", *first).repartition("group").sortWithinPartitions("group")
    needed = scratch.keep(shaped.mapInArrow(likely, "group long, rep long"))
    whole = groups.join(needed, ["group", "rep"]).join(sketch, "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    return whole.select("group", *first, "shingles").repartition("group").sortWithinPartitions("group").mapInArrow(exact, PAIRS)


def _size_class(n: F.Column, up: bool = False) -> F.Column:
    """Number of the size class: CLASSES an octave."""
    return F.floor(F.log2(n.cast("double")) * CLASSES + (1e-9 if up else -1e-9)).cast("int")


def _can_meet(left: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """rep of the rows of ``left`` (rep, comp) that may be linked to a row of another component: an exact prefix filter.

    Shingles of one component only are no rows of ``met``, so they cost a count; a shingle that very many
    rows share is counted beforehand, and its rows are joined to one row. A set's shingles come together
    again, as they lie together in ``sets``. A prefix is as long as the smallest size of the partner's
    size class allows.
    """
    own = scratch.keep(left.join(sets.select(F.col("id").alias("rep"), "shingles"), "rep").where(F.size("shingles") > 0))
    flat = own.select("rep", "comp", F.explode("shingles").alias("s"))
    met = scratch.keep(flat.groupBy("s").agg(F.count(F.lit(1)).alias("often"), F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("s", "often"))
    ordered = flat.join(met, "s").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("often", "s"))).alias("shared"))  # a set's shingles at most
    t = percent / 100
    n, least = F.col("n"), lambda m: F.ceil((n + m) * (t / (1 + t)) - 1e-6)  # noqa: E731  the overlap that sizes n and m need
    known = own.select("rep", "comp", F.size("shingles").alias("n")).join(ordered, "rep").where(F.size("shared") >= F.ceil(n * t - 1e-6))
    classes = F.sequence(_size_class(n * t), _size_class(n / t, up=True))
    other = F.col("other")
    smallest = F.greatest(F.ceil(F.pow(F.lit(2.0), other / CLASSES) - 1e-6), F.ceil(n * t - 1e-6))
    places = n - least(smallest) + 1 - (n - F.size("shared"))  # in the prefix, after the shingles that match nothing
    prefixes = known.select("rep", "comp", "n", "shared", F.explode(classes).alias("other")).withColumn("places", places.cast("int")).where("places > 0")
    mine = _size_class(n)
    key = F.xxhash64(F.least(mine, other), F.greatest(mine, other), "s")
    rows = scratch.keep(prefixes.select("rep", "comp", "n", "other", F.explode(F.transform(F.slice("shared", F.lit(1), F.col("places")), lambda x: x["s"])).alias("s")).select("rep", "comp", key.alias("key")))
    shared = scratch.keep(rows.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("key"))
    found = scratch.keep(rows.join(shared, "key", "left_semi").select("rep").distinct())
    scratch.drop(own, met, rows, shared)
    return found


def _without_those_far_from_all(members: DataFrame, sets: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``members`` (key, band, rep, comp), in buckets of more than a block only those that ``_can_meet``.

    Smaller buckets are one group of rows as they are.
    """
    hot = scratch.keep(members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > BLOCK).select("key"))
    if hot.isEmpty():
        return members
    inside = scratch.keep(members.join(hot, "key", "left_semi"))
    staying = _can_meet(inside.select("rep", "comp").distinct(), sets, percent, scratch)
    return scratch.keep(members.join(hot, "key", "left_anti").unionByName(inside.join(staying, "rep", "left_semi").select(*members.columns)))


def _most_crowded(members: DataFrame) -> DataFrame:
    """key, lead: of each bucket the member that meets most others in all of its buckets.

    What many copies were made from agrees with each of them more than they do with each other, so it
    lies in the largest buckets. As the leader it links them all at once.
    """
    met = members.groupBy("rep").agg(F.sum("size").alias("met"))
    return members.join(met, "rep").groupBy("key").agg(F.max_by("rep", F.struct("met", -F.col("rep"))).alias("lead"))


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs`` (doc_id, text).

    component_id: the least doc_id that links lead to, itself included; kept: whether it is the own.
    A text of fewer words is one shingle; a null text or one without words is linked with nothing;
    repeated rows get the same component, and so do rows with one doc_id and different texts; a null doc_id is linked with nothing and has a null
    component and is kept; an empty table gives an empty result; further columns are ignored.
    """
    scratch = Scratch(docs.sparkSession)
    own = scratch.keep(sketches(docs, words))
    classes = scratch.keep(
        own.where("digest is not null and doc_id is not null").groupBy("digest").agg(F.min(F.struct("doc_id", "n", "regs")).alias("least")).select("digest", F.col("least.doc_id").alias("rep"), F.col("least.n").alias("n"), F.col("least.regs").alias("regs"))
    )
    sketch = classes.select("rep", "n", "regs")
    banded = classes.select("rep", F.posexplode(_band_keys()).alias("band", "key"))
    shared = scratch.keep(banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    crowded = scratch.keep(banded.join(shared, "key"))
    leaders = scratch.keep(_most_crowded(crowded))
    members = scratch.keep(crowded.join(leaders, "key"))
    scratch.drop(shared, crowded, leaders)
    ids = scratch.keep(members.select(F.col("rep").alias("id")).distinct())
    known = ids.count()
    sets = scratch.keep(_full_sets(docs, ids, words, known))
    sketch = scratch.keep(few_of(sketch, "rep", ids, known).join(ids.withColumnRenamed("id", "rep"), "rep", "left_semi"))

    labels = None  # rep, comp of the classes that are not their component's least
    tried = None
    for number in range(LEADER_ROUNDS + 1):
        if not number:
            with_leader = members.where("rep <> lead")
        else:  # in a bucket of two the first round has compared all
            labelled = members.where("size > 2").select("key", "band", "rep").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
            mixed = scratch.keep(labelled.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min_by("rep", F.xxhash64("rep", "key", F.lit(number))).alias("lead"), F.min_by("comp", F.xxhash64("rep", "key", F.lit(number))).alias("lead_comp")).where("low < high"))
            current = scratch.keep(labelled.join(mixed.select("key", "lead", "lead_comp"), "key"))
            scratch.drop(mixed)
            if current.isEmpty():  # no bucket holds two components
                break
            with_leader = current.where("comp <> lead_comp")
        if number < LEADER_ROUNDS:
            pairs = with_leader.select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct()
            if tried is not None:
                pairs = pairs.join(tried, ["a", "b"], "left_anti")
            likely = scratch.keep(_estimated(pairs, sketch, percent))
            tried = likely if tried is None else tried.unionByName(likely)
            links = _verified(likely, sets, percent)
        else:
            left = _without_those_far_from_all(current.select("key", "band", "rep", "comp"), sets, percent, scratch)
            links = _blocks_compared(left, sketch, sets, percent, scratch)
        if labels is not None:
            of = labels.select(F.col("rep").alias("x"), F.col("comp").alias("y"))
            links = links.join(of, F.col("a") == F.col("x"), "left").select(F.coalesce("y", "a").alias("a"), "b")
            links = links.join(of, F.col("b") == F.col("x"), "left").select("a", F.coalesce("y", "b").alias("b"))
        joined = components(links, scratch).select(F.col("node").alias("x"), F.col("component").alias("y"))
        if labels is None:
            labels = joined.select(F.col("x").alias("rep"), F.col("y").alias("comp"))
        else:
            moved = labels.join(joined, F.col("comp") == F.col("x"), "left").select("rep", F.coalesce("y", "comp").alias("comp"))
            labels = scratch.keep(moved.unionByName(joined.select(F.col("x").alias("rep"), F.col("y").alias("comp"))))
    of_class = scratch.keep(classes.select("digest", "rep").join(labels, "rep", "left").select("digest", F.coalesce("comp", "rep").alias("component")))
    rows = scratch.keep(own.select("doc_id", "n", "digest"))
    scratch.drop_others(of_class, rows)
    component = F.coalesce("component", "doc_id")
    wordless = rows.where("digest is null").withColumn("component", F.lit(None).cast("long"))  # of no class: not to be sent to one task by the join
    return rows.where("digest is not null").join(of_class, "digest", "left").unionByName(wordless).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), component).alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` with the least doc_id of their component, with their columns.

    Rows that share that doc_id count as copies of one document: one of them stays.
    """
    found = near_duplicates(docs, words, percent).where("kept and doc_id is not null").select("doc_id").distinct()
    kept = docs.where("doc_id is not null").join(found, "doc_id", "left_semi")
    return kept.dropDuplicates(["doc_id"]).unionByName(docs.where("doc_id is null")).select(*docs.columns)
