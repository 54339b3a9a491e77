"""N-gram Jaccard join with a prefix tree, for near-duplicate classes of documents.

Every document becomes its set of word shingles, as sorted 64-bit hashes: the hash order is the global order.
Documents with equal sets are one node from there on.

*Routing.* Two sets of sizes a and b that link differ in at most (a + b)(1 - t) / (1 + t) shingles. The hash range is
cut into more parts than that, so some part is the same in both, and a signature per part brings the two together.
Very frequent shingles do no harm, for a part with one holds others too. Parts without a shingle are left out where
enough others must agree, and count as signatures where not. Small sets are routed by their prefix instead: of the
first a - ceil(t a) + 1 shingles in global order two linked sets share one.

*Joining.* Sets to be compared with one query set are put in global order into a trie, here the sorted list of the sets
with the depth each shares with the one before. The overlap along a shared path is computed once, and a subtree is left
as soon as the overlap so far and the lengths that remain can't reach the threshold.

*Sketches.* A set's sketch holds, for each of 512 places, whether an odd number of its shingles falls there. Two sets
differ in at least as many shingles as their sketches in places, so a pair whose sketches differ too much can't link and
its texts are not read. Sets of more than 512 shingles fill these places, so they have a second sketch with about a place
for each shingle; it is looked at once for each pair, and neither sketch ever rules out a link.

*Rounds.* The members of a signature are compared with one of them, not all with all: each set first with that one of
these it shares most signatures with, then with those outside its component. Found links make components. Only members
of different components that have not been compared go on. Where a signature has few members, their pairs are judged by
sketch at once. Of the members of the others only such go on as have enough shingles that occur in another component
too. The last round compares all that is left, so no link between components is lost.
Everything between the steps is a written table of ids and hashes.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from epidw.llm.bytehash import LOWER, SPACE, mix, run_bounds, shingle_hashes, span_hashes
from epidw.llm.common import slices, utf8, written

SHINGLE, PERCENT = 5, 80
#: sets from this size on are routed by parts
PARTED = 64
#: sizes of one class lie within this factor; at 50 percent or more a partner is in the same or the next class
CLASS_FACTOR = 1.6
#: nodes whose signatures a task remembers having sent, so that copies are folded before the shuffle
REMEMBERED = 200_000
#: 64-bit words of a sketch
SKETCH_WORDS = 8
#: sets of more shingles have a second sketch that grows with them
WIDE_FROM = 64 * SKETCH_WORDS
#: up to so many members of a signature are paired at once, which keeps the pairs looked at in proportion to the members
FEW_MEMBERS = 64
#: sets compared with one query set at a time; also the number of compared pairs dealt to one task's turn
TRIE_SETS = 256
#: nodes to compare are broadcast for the text scan up to this count, and joined by a shuffle beyond it
BROADCAST_NODES = 1_000_000


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, whose words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lowered."""
    data, starts = utf8(texts)
    for a, b in slices(starts):
        low = int(starts[a])
        part, ends = data[low : int(starts[b])], starts[a + 1 : b + 1] - low
        begin, stop = run_bounds(~SPACE[part], ends)
        words = span_hashes(LOWER[part], begin, stop)
        hashes = shingle_hashes(words, size)  # those that run on into the next text are left out below
        first = 0
        for last in np.searchsorted(begin, ends).tolist():
            found = hashes[first : last - size + 1] if last - first >= size else shingle_hashes(words[first:last], size)
            yield distinct(found)
            first = last


def distinct(hashes: np.ndarray) -> np.ndarray:
    """Sorted, each once."""
    found = np.sort(hashes)
    new = np.ones(len(found), bool)
    np.not_equal(found[1:], found[:-1], out=new[1:])
    return found[new]


def node_of(shingles: np.ndarray) -> int:
    """Identifier of a set; that two sets of n share one is as likely as n * n in 2**65."""
    total = np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)))
    return int(mix(np.array([total + np.uint64(len(shingles))], np.uint64)).view(np.int64)[0])


def sketch(shingles: np.ndarray) -> np.ndarray:
    """For each place, as a bit, whether an odd number of shingles falls there."""
    places = 64 * SKETCH_WORDS
    fallen = np.bincount((shingles % np.uint64(places)).astype(np.int64), minlength=places)
    return np.packbits((fallen & 1).astype(np.uint8)).view(np.int64)


def wide_sketch(shingles: np.ndarray) -> np.ndarray | None:
    """A sketch of so many words, a power of two, that there is a place for each shingle; none for small sets."""
    if len(shingles) <= WIDE_FROM:
        return None
    places = 64 << ((len(shingles) - 1) // 64).bit_length()
    fallen = np.bincount((shingles & np.uint64(places - 1)).astype(np.int64), minlength=places)
    return np.packbits((fallen & 1).astype(np.uint8)).view(np.int64)


def wide_can_link(a: str, b: str, percent: int) -> str:
    """Condition on ``n_shingles`` and ``wide`` of two sets whose sizes allow a link; true where one has no wide sketch.

    Such sizes differ by a factor below 2, so the longer sketch has as many words as the other or twice as many. Then its
    halves are laid over each other, which gives the sketch of the shorter length.
    """
    one, other = f"{a}wide", f"{b}wide"
    folded = " ^ ".join(f"IF(size({x}) > size({y}), get({x}, i + size({y})), 0L)" for x, y in ((one, other), (other, one)))
    apart = f"aggregate(sequence(0, least(size({one}), size({other})) - 1), 0L, (s, i) -> s + bit_count(get({one}, i) ^ get({other}, i) ^ {folded}))"
    return (
        f"{one} IS NULL OR {other} IS NULL"
        f" OR {apart} * {100 + percent} <= ({a}n_shingles + {b}n_shingles) * {100 - percent}"
    )


def can_link(a: str, b: str, percent: int) -> str:
    """Condition on ``n_shingles`` and ``bits`` of two sets, behind the given prefixes, that every pair that links meets."""
    sizes = f"{a}n_shingles, {b}n_shingles"
    apart = " + ".join(f"bit_count({a}bits[{i}] ^ {b}bits[{i}])" for i in range(SKETCH_WORDS))
    return (
        f"least({sizes}) * 100 >= greatest({sizes}) * {percent}"
        f" AND ({apart}) * {100 + percent} <= ({a}n_shingles + {b}n_shingles) * {100 - percent}"
    )


def most_differing(total: int, percent: int) -> int:
    """Most shingles in which two sets of ``total`` shingles together can differ and still link."""
    return total * (100 - percent) // (100 + percent)


def size_class(size: int) -> tuple[int, int]:
    """First size of the class of ``size`` and of the next one."""
    low = PARTED
    while True:
        high = int(low * CLASS_FACTOR) + 1
        if size < high:
            return low, high
        low = high


def part_signatures(shingles: np.ndarray, low: int, high: int, percent: int) -> np.ndarray:
    """Signatures of parts of the hash range, for partners in the class from ``low`` to ``high``.

    Only the first parts are sent: so many that some ``same`` of them agree with any partner that links. The smaller set
    of a pair sends the fewer parts, and the larger one sends those too.
    """
    size = len(shingles)
    parts = most_differing(2 * (high - 1), percent) + 2
    differing = most_differing(size + min(high - 1, size * 100 // percent), percent)
    sent = min(parts, differing + 2 + parts // 16)
    same = sent - differing
    place = ((shingles >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    end = int(np.searchsorted(place, np.uint64(sent)))
    if not end:
        return mix(mix(np.arange(sent, dtype=np.uint64) + np.uint64(low)) + np.uint64(parts))
    shingles, place = shingles[:end], place[:end]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    sums = np.add.reduceat(mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)), first)
    found = mix(sums + (place[first] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(low))
    if sent - len(first) < same:
        return found
    empty = np.setdiff1d(np.arange(sent, dtype=np.uint64), place)
    return np.concatenate([found, mix(mix(empty + np.uint64(low)) + np.uint64(parts))])


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of which two different sets that link share at least one."""
    size = len(shingles)
    found = []
    if size < PARTED:
        found.append(mix(shingles[: size - -(-size * percent // 100) + 1] + np.uint64(1)))
        low, high = PARTED, size_class(PARTED)[1]
    else:
        low, high = size_class(size)
        found.append(part_signatures(shingles, low, high, percent))
        low, high = high, size_class(high)[1]
    if size * 100 >= low * percent:  # a partner may be in the next class
        found.append(part_signatures(shingles, low, high, percent))
    return np.concatenate(found)


def linked(query: np.ndarray, sets: list[np.ndarray], percent: int) -> list[bool]:
    """Which ``sets`` link with ``query``: a walk through the trie of the sets in global order."""
    order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
    answer = [False] * len(sets)
    previous, reached = np.empty(0, np.uint64), np.zeros(1, np.int64)
    for i in order:
        path = sets[i]
        need = -(-(len(query) + len(path)) * percent // (100 + percent))
        common = min(len(previous), len(path))
        unlike = np.flatnonzero(previous[:common] != path[:common])
        shared = min(int(unlike[0]) if len(unlike) else common, len(reached) - 1)
        overlap = reached[: shared + 1]
        # what lies behind the shared path can add no more than what is left of the set and of the query
        if overlap[shared] + min(len(path) - shared, len(query) - overlap[shared]) < need:
            previous, reached = path, overlap
            continue
        depth, ahead = shared, 64
        while depth < len(path):
            step, ahead = path[depth : depth + ahead], ahead * 8
            place = np.minimum(np.searchsorted(query, step), len(query) - 1)
            overlap = np.concatenate([overlap, overlap[-1] + np.cumsum(query[place] == step)])
            depth += len(step)
            rest = len(query) - int(np.searchsorted(query, step[-1], side="right"))
            if overlap[-1] + min(len(path) - depth, rest) < need:
                break
        previous, reached = path, overlap
        both = int(overlap[-1])
        answer[i] = depth == len(path) and 100 * both >= percent * (len(query) + len(path) - both)
    return answer


def near_classes(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per document (columns ``doc_id``, ``text``): ``doc_id``, ``n_shingles``, ``component_id``, and the
    identifiers of its set (``node``), of its class (``component``) and of its text (``text_hash``).

    Documents link when the Jaccard similarity of their sets of ``size``-word shingles is ``percent`` or more;
    ``component_id`` is the smallest ``doc_id`` that links lead to. A text with fewer words is one shingle. A null text
    or one without words has no shingle, is linked with nothing and has a null ``node``. Equal sets link, also of
    repeated rows. A null ``doc_id`` takes part but is never a ``component_id`` if its component has another id.
    Further columns are ignored. ``percent`` must be 63 or more.
    """
    if not 63 <= percent <= 100:
        raise ValueError("percent must be from 63 to 100")
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    described = written(_describe(rows, size, percent), "described")
    nodes = described.filter("sig IS NULL").drop("sig", "wide")
    wides = described.filter("wide IS NOT NULL").select("node", "n_shingles", "wide").dropDuplicates(["node"])
    meetings = written(_meetings(described.filter("sig IS NOT NULL").select("sig", "node")), "meetings")
    components = _components(rows, nodes, meetings, written(wides, "wides"), size, percent)
    named = nodes.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.filter("node IS NOT NULL").groupBy("component").agg(F.min("doc_id").alias("smallest"))
    inner = ["node", "component", "text_hash"]
    alone = named.filter("node IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *inner)
    together = named.join(smallest, "component").select("doc_id", "n_shingles", F.col("smallest").alias("component_id"), *inner)
    return together.unionByName(alone)


def _describe(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """A row for each document, without ``sig``, and rows of ``sig`` and ``node`` for the signatures of each node."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "text_hash", "n_shingles", "node", "bits", "wide", "sig"]
    words = pa.list_(pa.int64())

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: OrderedDict[int, None] = OrderedDict()
        for batch in batches:
            kind, sizes, known, bits, wide, held, count = batch.column("doc_id").type, [], [], [], [], [], 0

            def signed() -> pa.RecordBatch:
                sigs = np.concatenate([found for found, _ in held]).view(np.int64)
                of = np.repeat(np.array([node for _, node in held], np.int64), [len(found) for found, _ in held])
                none = pa.nulls(len(sigs), pa.int64())
                return pa.RecordBatch.from_arrays([none.cast(kind), none, none, pa.array(of), *[pa.nulls(len(sigs), words)] * 2, pa.array(sigs)], names)  # noqa: B023

            for shingles in shingle_sets(batch.column("text"), size):
                node = node_of(shingles) if len(shingles) else None
                sizes.append(len(shingles))
                known.append(node)
                bits.append(sketch(shingles))
                wide.append(wide_sketch(shingles) if node not in sent else None)  # as the signatures, once for copies in a task
                if node is not None and node not in sent:
                    sent[node] = None
                    if len(sent) > REMEMBERED:
                        sent.popitem(last=False)
                    held.append((distinct(signatures(shingles, percent)), node))
                    count += len(held[-1][0])
                    if count > 1 << 16:
                        yield signed()
                        held, count = [], 0
            if held:
                yield signed()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(known, pa.int64()),
                 pa.array(bits, words), pa.array(wide, words), pa.nulls(len(sizes), pa.int64())], names)

    return docs.mapInArrow(describe, f"doc_id {id_type}, text_hash long, n_shingles long, node long, bits array<long>, wide array<long>, sig long")


def _meetings(signed: DataFrame) -> DataFrame:
    """(``sig``, ``node``, ``center``): nodes that share a signature, beside the smallest of them, which is left out."""
    ordered = Window.partitionBy("sig").orderBy("node")
    met = signed.repartition("sig").select(
        "sig", "node", F.first("node").over(ordered).alias("center"), F.lag("node").over(ordered).alias("before")
    )
    return met.filter("before IS NOT NULL AND node <> before").select("sig", "node", "center")


def _components(docs: DataFrame, nodes: DataFrame, meetings: DataFrame, wides: DataFrame, size: int, percent: int) -> DataFrame:
    """``node`` and ``component`` of all nodes that link."""
    members = meetings.select("sig", "node").unionByName(meetings.select("sig", F.col("center").alias("node")).distinct())
    sets = written(nodes.filter("node IS NOT NULL").select("node", "n_shingles", "bits").dropDuplicates(["node"]), "sets")
    met = meetings.groupBy(F.col("center").alias("one"), F.col("node").alias("other")).agg(F.count("*").alias("times"))
    met = written(_wide_possible(_possible(met, sets, percent), wides, percent), "met")
    nearest = met.groupBy("other").agg(F.max(F.struct("times", "one")).alias("nearest")).select("nearest.one", "other")
    tested = written(_compare(docs, nodes, nearest, size, percent), "compared")
    components = _connect(tested.filter("links").select("one", "other"))

    def compared(pairs: DataFrame) -> None:
        nonlocal tested, components
        fresh = _wide_possible(pairs.join(tested.select("one", "other"), ["one", "other"], "left_anti"), wides, percent)
        answers = written(_compare(docs, nodes, fresh, size, percent), "compared")
        tested = tested.unionByName(answers)
        if not answers.filter("links").isEmpty():
            components = _connect(tested.filter("links").select("one", "other"))

    compared(_apart(met.select("one", "other"), components))
    few = _unsettled(members, components).filter(F.col("size") <= FEW_MEMBERS).join(sets, "node")
    compared(_all_pairs(few, percent))
    for pairs in (_stars, _all_pairs):
        left = written(_unsettled(members, components).filter(F.col("size") > FEW_MEMBERS), "members")
        if left.isEmpty():
            break
        able = written(_promising(docs, nodes, left, sets, size, percent), "promising")
        if able.isEmpty():
            break
        compared(pairs(able, percent))
    return components


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and sketches allow a link."""
    known = pairs.alias("p").join(sets.alias("l"), F.expr("p.one = l.node"))
    return known.join(sets.alias("r"), F.expr(f"p.other = r.node AND {can_link('l.', 'r.', percent)}")).select("p.*")


def _wide_possible(pairs: DataFrame, wides: DataFrame, percent: int) -> DataFrame:
    """The pairs, whose sizes allow a link, that the sketches of large sets allow one too."""
    known = pairs.alias("p").join(wides.alias("l"), F.expr("p.one = l.node"), "left").join(wides.alias("r"), F.expr("p.other = r.node"), "left")
    return known.filter(wide_can_link("l.", "r.", percent)).select("p.*")


def _apart(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """The pairs whose nodes are not in one component."""
    one = components.select(F.col("node").alias("one"), F.col("component").alias("one_in"))
    other = components.select(F.col("node").alias("other"), F.col("component").alias("other_in"))
    known = pairs.join(one, "one", "left").join(other, "other", "left")
    return known.filter("coalesce(one_in, one) <> coalesce(other_in, other)").select("one", "other")


def _stars(members: DataFrame, percent: int) -> DataFrame:
    """Each member of a signature with one of them, another than in the first round, if they can still link."""
    by_turn = Window.partitionBy("sig").orderBy(F.xxhash64("node", F.lit(1)), "node")
    center = F.first(F.struct("node", "component", "n_shingles", "bits")).over(by_turn).alias("c")
    met = members.select("node", "component", "n_shingles", "bits", center)
    met = met.filter("component <> c.component").filter(can_link("", "c.", percent))
    return met.select(F.least("node", "c.node").alias("one"), F.greatest("node", "c.node").alias("other")).distinct()


def _all_pairs(members: DataFrame, percent: int) -> DataFrame:
    """The members of different components that share a signature and whose sizes and sketches allow a link."""
    apart = f"l.sig = r.sig AND l.node < r.node AND l.component <> r.component AND {can_link('l.', 'r.', percent)}"
    met = members.alias("l").join(members.alias("r"), F.expr(apart))
    return met.select(F.col("l.node").alias("one"), F.col("r.node").alias("other")).distinct()


def _unsettled(members: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the signatures that three or more nodes of several components share.

    The only pair of a signature with two members has been compared or is in one component.
    """
    known = members.join(components, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("component"))
    several = known.groupBy("sig").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    return known.join(several.filter("low < high AND size > 2").select("sig", "size"), "sig")


def _promising(docs: DataFrame, nodes: DataFrame, members: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The members that can link beyond their component, with ``n_shingles`` and ``bits``.

    A shingle that no other component has can't be in an overlap with one. So ``shared``, the number of the others, is
    all that can remain of a set, and it must reach the overlap asked for with the smallest set of the signature.
    """
    who = members.select("node", "component").distinct()
    texts = _texts(docs, nodes, who.select("node")).join(who, "node")

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, shingles in enumerate(shingle_sets(batch.column("text"), size)):
                columns = [pa.array(shingles.view(np.int64))]
                columns += [pa.array(np.full(len(shingles), batch.column(c)[at].as_py(), np.int64)) for c in ("node", "component")]
                yield pa.RecordBatch.from_arrays(columns, ["shingle", "node", "component"])

    spelled = texts.select("text", "node", "component").mapInArrow(spell, "shingle long, node long, component long")
    within = Window.partitionBy("shingle")
    common = spelled.select("node", F.min("component").over(within).alias("low"), F.max("component").over(within).alias("high"))
    shared = common.filter("low < high").groupBy("node").agg(F.count("*").alias("shared"))
    sized = sets.join(shared, "node")
    smallest = F.min("n_shingles").over(Window.partitionBy("sig"))
    known = members.join(sized, "node").withColumn("least", F.greatest(smallest, F.ceil(F.col("n_shingles") * percent / 100)))
    able = known.filter(F.col("shared") * (100 + percent) >= (F.col("n_shingles") + F.col("least")) * percent)
    by_sig = Window.partitionBy("sig")
    able = able.withColumn("low", F.min("component").over(by_sig)).withColumn("high", F.max("component").over(by_sig))
    return able.filter("low < high").select("sig", "node", "component", "n_shingles", "bits")


def _texts(docs: DataFrame, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node`` and ``text`` of one document for each wanted node; fully repeated rows give it as often."""
    first = nodes.join(wanted, "node").groupBy("node").agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
    chosen = written(first.select("node", F.col("first.doc_id").alias("first_id"), F.col("first.text_hash").alias("first_hash")), "wanted")
    if chosen.limit(BROADCAST_NODES + 1).count() <= BROADCAST_NODES:
        chosen = F.broadcast(chosen)
    same = docs["doc_id"].eqNullSafe(chosen["first_id"]) & (docs["text_hash"] == chosen["first_hash"])
    return docs.join(chosen, same).select("node", "text")


def _compare(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` (``one``, ``other``) with ``links``. A set that meets many is dealt to as many turns as it needs."""
    pairs = written(pairs.select("one", "other"), "pairs")
    wanted = pairs.select(F.col("one").alias("node")).unionByName(pairs.select(F.col("other").alias("node"))).distinct()
    texts = _texts(docs, nodes, wanted)
    turns = pairs.groupBy("one").agg(F.ceil(F.count("*") / TRIE_SETS).alias("turns"))
    dealt = pairs.join(turns, "one").select("one", "other", F.pmod(F.xxhash64("other"), "turns").alias("turn"))
    dealt = written(dealt, "dealt")
    queries = dealt.select("one", "turn").distinct().join(texts.withColumnRenamed("node", "one"), "one")
    queries = queries.select("one", "turn", F.lit(None).cast("long").alias("other"), "text")
    stored = dealt.join(texts.withColumnRenamed("node", "other"), "other").select("one", "turn", "other", "text")
    arranged = queries.unionByName(stored).repartition("one", "turn").sortWithinPartitions("one", "turn", F.col("other").asc_nulls_first())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, held = None, []

        def answers() -> pa.RecordBatch:
            found = linked(query[1], [s for _, s in held], percent)
            return pa.RecordBatch.from_arrays(
                [pa.array([query[0]] * len(held), pa.int64()), pa.array([n for n, _ in held], pa.int64()), pa.array(found, pa.bool_())],
                ["one", "other", "links"])

        for batch in batches:
            names = zip(batch.column("one").to_pylist(), batch.column("other").to_pylist())
            for (one, other), shingles in zip(names, shingle_sets(batch.column("text"), size)):
                if other is None:
                    if held:
                        yield answers()
                    query, held = (one, shingles), []
                elif not held or held[-1][0] != other:
                    if len(held) == TRIE_SETS:
                        yield answers()
                        held = []
                    held.append((other, shingles))
        if held:
            yield answers()

    return arranged.mapInArrow(compare, "one long, other long, links boolean")


def _connect(links: DataFrame) -> DataFrame:
    """Components of the links: each node takes the smallest label around it, then the label of its label."""
    both = written(links.unionByName(links.select(F.col("other").alias("one"), F.col("one").alias("other"))), "links")
    labels = written(both.groupBy("one").agg(F.least(F.col("one"), F.min("other")).alias("component")).withColumnRenamed("one", "node"), "labels")
    while True:
        around = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy(F.col("one").alias("node")).agg(F.min("component").alias("near"))
        lower = labels.join(around, "node").select("node", F.least("component", "near").alias("component"), F.col("component").alias("held"))
        above = lower.select(F.col("node").alias("component"), F.col("component").alias("top"))
        jumped = lower.join(above, "component").select("node", F.col("top").alias("component"), (F.col("top") < F.col("held")).alias("moved"))
        jumped = written(jumped, "labels")
        labels = jumped.select("node", "component")
        if jumped.filter("moved").isEmpty():
            return labels


def one_of_each(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of each near-duplicate class that of the smallest ``doc_id``.

    Texts without words are linked with nothing and all stay. Rows are known by ``doc_id`` and text, so rows that repeat
    an id are judged each by its own text, and of fully repeated rows one stays. A null ``doc_id`` stays only if its class
    has no other.
    """
    found = near_classes(docs, size, percent).filter("node IS NOT NULL")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash"))
    rows = found.join(found.groupBy("component").agg(first.alias("first")), "component")
    stays = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash"))
    keys = [F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")]
    lost = rows.filter(~stays).select(*keys).distinct()
    doubled = rows.filter(stays).groupBy(*keys).count().filter("count > 1").select("__id", "__hash")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text") == F.col("__hash"))
    kept = docs.withColumn("__text", F.xxhash64("text")).join(lost, same, "left_anti")
    copies = Window.partitionBy("doc_id", "__text").orderBy(F.lit(1))
    once = kept.join(doubled, same, "left_semi").withColumn("__row", F.row_number().over(copies)).filter("__row = 1").drop("__row")
    return kept.join(doubled, same, "left_anti").unionByName(once).drop("__text")
