"""The text preparation operators against brute force, exact round trips and held-out accuracy, on small tables."""

import hashlib
import itertools
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from epidw.llm import chat, codes, common, exact, fingerprints, jaccard, language, mixing, packing, quality, queries, subwords, tokens, toxicity
from epidw.llm.tokens import encoder

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "\n\t ", "a", "a", "é ́x", "Σας ΟΔΟΣ", "  two  blanks\n\n\nand lines ", "'s it's don't\n't", "a \x1cb\x1fc \x01 d", "日本 語 x" * 3]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts with null and repeated ids, and columns named as the operators' own."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [(i if i != 3 else None, t, "x", 1.0, 2) for i, t in enumerate([*ODD, long, long + " end"])] + [(5, "a", "y", 0.0, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, node string, score double, bin int")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, node string, lang string")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_encoder_equals_the_tokenizer(path):
    plain = Tokenizer.from_file(path)
    random.seed(3)
    signs = ["a", "b", " ", "\n", "é", "'s", ".", "1", "\x1c", "́", "\x01", "|", "\t", "\u00a0", "\u2003", "\u3000", "«", "日", "ぁ", "\x85", "<|endoftext|>", "<|startoftext|>"]
    drawn = ["".join(random.choices(signs, k=n % 30)) for n in range(1200)]
    texts = [t or "" for t in ODD] + drawn
    expected = [plain.encode(text, add_special_tokens=False).ids for text in texts]
    assert [encoder(path).encode(text).tolist() for text in texts] == expected
    found = [ids[x:y].tolist() for _, _, ids, upto in encoder(path).encode_slices(pa.array([None, *texts])) for x, y in zip(upto, upto[1:])]
    assert found == [[], *expected]


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_ids_do_not_depend_on_slices(path, monkeypatch):
    text = "".join(f"word{i % 613} n{i}{' ' if i % 5 else chr(10)}" for i in range(3000)) + "x" * 5000 + " é \u00a0 end <|endoftext|> z"
    texts = [text, "", "short one", text.replace(" ", "\t"), "y" * 9000]
    expected = [Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids for t in texts]
    for most, kept in ((1 << 20, 400_000), (4096, 400_000), (64, 50)):
        monkeypatch.setattr(tokens, "ENCODED_BYTES", most)
        monkeypatch.setattr(tokens, "KEPT_PARTS", kept)
        one = tokens.Encoder(path)
        for _ in range(2):
            assert [ids[x:y].tolist() for _, _, ids, upto in one.encode_slices(pa.array(texts)) for x, y in zip(upto, upto[1:])] == expected


def test_packing_places_every_piece_once(odd, docs):
    for table, most in ((odd, None), (docs, 1)):
        rows = packing.pack_documents(table, BYTES).collect()
        spans = defaultdict(list)
        for r in rows:
            spans[r.sequence_id].append((r.offset, r.length))
        for held in spans.values():
            held.sort()
            assert [o for o, _ in held] == [0, *itertools.accumulate(n for _, n in held)][:-1] and sum(n for _, n in held) <= 2048
        if most is not None:
            assert len(spans) <= -(-sum(r.length for r in rows) // 2048) + most
    plain = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in rows[:60]:
        ids = np.array([*plain.encode(texts[r.doc_id], add_special_tokens=False).ids, 0], "<u4")
        assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32


def test_packing_cuts_and_best_fit(empty):
    assert packing.cut(5000, 2048) == [(0, 904), (904, 2048), (2952, 2048)] and packing.cut(2048, 2048) == [(0, 2048)]
    bins, places, loads = packing.best_fit(np.array([5, 5, 3, 7, 10]), 10)
    assert loads.sum() == 30 and len(loads) == 3
    assert packing.pack_documents(empty, BYTES).count() == 0


def test_underfull_sequences_meet_in_the_tree(spark):
    rows = [((task << 40) + 1, 900) for task in range(40)]
    bins = spark.createDataFrame(rows, "bin long, load long")
    moved = packing.merge_underfull(bins, 2048, 4).collect()
    assert Counter(Counter(r.to for r in moved).values()) == {2: 20} and {r.shift for r in moved} == {0, 900}


@pytest.mark.parametrize("loads", [[1500] * 900 + [500] * 40, [1025] * 600 + [1023] * 6, [2000] * 300 + [40] * 3 + [8] * 2, list(range(1025, 2030)) * 2])
def test_no_sequence_more_than_without_a_bound_on_what_is_handed_up(spark, loads):
    random.seed(len(loads))
    random.shuffle(loads)
    rows, at = [], 0
    for task in range(30):  # what a task hands up is packed already: one load up to half full at most
        mine = loads[at : at + len(loads) // 30 + 1]
        at += len(mine)
        _, _, packed = packing.best_fit(np.array(mine, np.int64), 2048)
        rows += [((task << 40) + i, int(n)) for i, n in enumerate(packed)]
    moved = packing.merge_underfull(spark.createDataFrame(rows, "bin long, load long"), 2048, 4).collect()
    size, total = dict(rows), Counter()
    for r in moved:
        total[r.to] += size[r.bin]
    full = sum(1 for _, n in rows if n >= 2048 - packing.NEARLY_FULL)
    everything = packing.best_fit(np.array([n for _, n in rows if n < 2048 - packing.NEARLY_FULL], np.int64), 2048)[2]
    assert max(total.values(), default=0) <= 2048 and len(total) + full <= len(everything) + full


def test_codes_round_trip_and_random_access():
    random.seed(5)
    ids = np.array([random.choice([0, 255, 256, 49_407, 70_000, 1 << 24]) for _ in range(3000)], np.uint32)
    read = codes.Codes(codes.encode_codes(ids))
    assert read.ids(0, 3000).tolist() == ids.tolist() and read.ids(517, 1025).tolist() == ids[517:1025].tolist()
    assert [read.get(i) for i in (0, 511, 512, 2999)] == ids[[0, 511, 512, 2999]].tolist()
    assert len(codes.Codes(codes.encode_codes(ids[:0]))) == 0


def test_token_files_hold_all_ids_in_order(spark, docs, odd, empty, folder):
    codes.write_token_files(docs, WORDS, f"{folder}/a", parts=5)
    rows = codes.read_token_files(spark, f"{folder}/a").orderBy("doc_id").collect()
    plain, start, stream = Tokenizer.from_file(WORDS), 0, []
    for doc, row in zip(docs.orderBy("doc_id").collect(), rows):
        ids = [*plain.encode(doc.text or "", add_special_tokens=False).ids, 1]
        assert tuple(row) == (doc.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        stream += ids
    assert codes.read_ids(spark, f"{folder}/a", start // 2).first().id == stream[start // 2]
    codes.write_token_files(odd, WORDS, f"{folder}/b")
    assert codes.read_token_files(spark, f"{folder}/b").count() == odd.count()
    codes.write_token_files(empty, WORDS, f"{folder}/c")
    assert codes.read_token_files(spark, f"{folder}/c").count() == 0


def test_fingerprints_of_equal_and_edited_texts(docs, odd, empty):
    found = {r.doc_id: r for r in fingerprints.fingerprints(docs, parts=4).collect()}
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    order = sorted(texts, reverse=True)
    for doc, following in zip(order, order[1:] + order[:1]):
        edited = fingerprints.edit(texts[doc], texts[following])
        assert found[doc].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert fingerprints.from_text(found[doc].fingerprint) == fingerprints.fingerprint(texts[doc])
        assert found[doc].near_next == fingerprints.containment(fingerprints.fingerprint(texts[doc]), fingerprints.fingerprint(texts[following]))
    base = " ".join(f"word{i * 7919 % 1000}" for i in range(500))
    assert fingerprints.resemblance(fingerprints.fingerprint(base), fingerprints.fingerprint("new start " + base)) > 0.9
    assert fingerprints.fingerprints(odd, parts=3).count() == odd.count() and fingerprints.fingerprints(empty, parts=3).count() == 0


def test_exact_groups_on_odd_texts(odd, empty):
    rows = exact.exact_groups(odd).collect()
    groups = Counter(re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in odd.collect())
    assert len(rows) == odd.count()
    assert Counter(r.text_sha256 for r in rows) == Counter({hashlib.sha256(t.encode()).hexdigest(): n for t, n in groups.items()})
    assert exact.without_copies(odd).count() == len(groups)
    assert exact.without_copies(odd).columns == odd.columns and exact.exact_groups(empty).count() == 0


def test_identifiers_that_clash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(exact, "identifier", lambda chunk: exact.F.length(chunk).cast("bigint"))
    table = spark.createDataFrame([(1, "abc"), (2, "abd"), (3, "a b c"), (4, "xyz")], "doc_id long, text string")
    assert {r.doc_id: r.keep_id for r in exact.exact_groups(table).collect()} == {1: 3, 2: 2, 3: 3, 4: 4}


def test_chat_formats_reversibly(spark, empty):
    rows = [(1, 0, "user", "</s>[INST] ok [/INST]: \\"), (1, 1, "assistant", "<s>\\b"), (2, 0, None, None), (2, 0, None, None), (None, 1, "system", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.render_conversations(turns).collect()}
    assert chat.read_back(found[1].formatted) == [("user", rows[0][3]), ("assistant", rows[1][3])]
    assert [chat.unescape(found[1].formatted[a:b]) for a, b in found[1].loss] == ["<s>\\b"]
    assert found[2].n_turns == 2 and found[None].n_turns == 1
    assert chat.render_conversations(turns.limit(0)).count() == 0


def test_templates_that_rewrite_history_are_found():
    def counting(turns):
        return f"{len(turns)} turns: " + "".join(t for _, t in turns)

    with pytest.raises(chat.HistoryRewritten):
        chat.turn_spans([("user", "a"), ("assistant", "b")], counting)


def test_assistant_texts_are_found_in_any_template(spark):
    def tagged(turns):
        return "".join(f"<{role}>{text}</s>" for role, text in turns)

    def rewriting(turns):
        return f"{len(turns)}:" + tagged(turns) if turns and turns[0][1] == "rewrite" else tagged(turns)

    def twice(turns):
        return "".join(text + text for _, text in turns)

    turns = [("user", "s"), ("assistant", "a"), ("assistant", ""), ("assistant", "</s><assistant>")]
    output, spans = chat.turn_spans(turns, tagged)
    found = chat.loss_spans(turns, tagged, output, spans)
    assert [output[a:b] for a, b in found] == ["a", "", "</s><assistant>"] and found[0][0] == len("<user>s</s><assistant>")
    with pytest.raises(chat.TextNotFound):
        chat.loss_spans(turns, twice, *chat.turn_spans(turns, twice))
    rows = [(c, t, *turn) for c in (1, 2) for t, turn in enumerate(turns)]
    rows[0] = (1, 0, "user", "rewrite")
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    first, second = chat.render_conversations(table, rewriting).orderBy("conv_id").collect()
    assert (first.problem, first.spans, first.loss) == ("history rewritten", None, None) and first.formatted.startswith("4:")
    assert (second.problem, len(second.spans), len(second.loss)) == (None, 4, 3)
    assert chat.render_conversations(table, twice).filter("problem = 'text not found' AND loss IS NULL").count() == 2


def test_a_long_conversation(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} [" + "x" * t) for t in range(400)]
    found = chat.render_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).first()
    assert [chat.unescape(found.formatted[a:b]) for a, b in found.loss] == [text for _, _, role, text in rows if role == "assistant"]
    assert [t for _, t in chat.read_back(found.formatted)] == [text for *_, text in rows]


@pytest.mark.parametrize("letters", ["абвгдежзийклмнопрстуфхцчшщъыьэюя", "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "αβγδεζηθικλμνξοπρστυφχψω",
                                     "".join(map(chr, range(0x4E00, 0x6E00))), "".join(map(chr, range(0x3041, 0x3094))),
                                     "".join(map(chr, range(0xAC00, 0xC000))), "अआइईउऊएऐओऔकखगघचछजझटठडढतथदधनपफबभमयरलवशषसह", "0123456789"])
def test_chunks_of_every_script_are_cut_by_content(spark, letters):
    random.seed(5)
    text = "".join(random.choices(letters, k=120_000))
    table = spark.createDataFrame([(text,), (text[:7] + "x" * 100 + text[7:],)], "text string")
    one, other = (r[0] for r in table.select(exact.chunks(exact.F.col("text"))).collect())
    assert "".join(one) == text and max(map(len, one)) < exact.LONGEST
    assert len(set(one) & set(other)) > len(one) / 2


def test_ids_of_any_type(spark, docs):
    texts = docs.select(exact.F.concat(exact.F.lit("é"), exact.F.col("doc_id").cast("string")).alias("doc_id"), "text").limit(300)
    numbered = docs.select("doc_id", "text").limit(300)
    found, same = ({r.doc_id: r for r in exact.exact_groups(t).collect()} for t in (texts, numbered))
    assert {d: (r.group_size, r.text_sha256) for d, r in found.items()} == {f"é{d}": (r.group_size, r.text_sha256) for d, r in same.items()}
    assert exact.without_copies(texts).count() == exact.without_copies(numbered).count()
    ids = sorted(texts.collect(), reverse=True)
    prints = {r.doc_id: r for r in fingerprints.fingerprints(texts, parts=7).collect()}
    for row, following in zip(ids, ids[1:] + ids[:1]):
        edited = fingerprints.edit(row.text or "", following.text or "")
        assert prints[row.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def test_ranges_are_found_by_blocks(spark):
    bounds = sorted(random.Random(2).sample(range(1000), 57))
    for some in ([], bounds[:1], bounds[:9], bounds):
        rows = spark.range(-1, 1001).select("id", fingerprints.range_of(exact.F.col("id"), some).alias("n")).collect()
        assert all(r.n == sum(b < r.id for b in some) for r in rows)


def brute_cuts(text):
    """Chunk ends by a plain loop over positions, each hash summed anew."""
    ends, start = [], 0
    for end in range(1, len(text) + 1):
        window = text[max(0, end - fingerprints.WINDOW) : end]
        hashed = sum(int(fingerprints.GEAR[ord(c) & 0xFFFF]) << (4 * back) for back, c in enumerate(reversed(window))) & 0xFFFFFFFF
        mask = int(fingerprints.EARLY_MASK if end - start < fingerprints.NORMAL else fingerprints.LATE_MASK)
        if end - start >= fingerprints.SHORTEST and hashed & mask == 0 or end - start == fingerprints.LONGEST or end == len(text):
            ends.append(end)
            start = end
    return ends


def test_cuts_equal_a_plain_loop(docs):
    for text in [r.text or "" for r in docs.limit(60).collect()] + ["a" * 500, "日本" * 200, "", "x"]:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        assert fingerprints.cuts(points) == brute_cuts(text)


def brute_classes(rows, size, percent):
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()
    label = {d: d for d in sets}
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            old, new = sorted((label[a], label[b]))[::-1]
            label = {d: new if x == old else x for d, x in label.items()}
    return {d: (len(s), label[d]) for d, s in sets.items()}


@pytest.mark.parametrize("size,percent,few", [(4, 85, jaccard.FEW_MEMBERS), (5, 80, jaccard.FEW_MEMBERS), (4, 85, 2)])
def test_near_classes_equal_brute_force(spark, monkeypatch, size, percent, few):
    monkeypatch.setattr(jaccard, "FEW_MEMBERS", few)
    random.seed(percent)
    rows = []
    for base in (4, 12, 30, 70, 90, 150, 400, 560, 1060):
        words = [f"w{random.randrange(4000)}" for _ in range(base)]
        for _ in range(14):
            copy = list(words)
            for _ in range(random.randrange(0, 2 + base // 30)):
                copy[random.randrange(base)] = f"n{random.randrange(10**6)}"
            if random.random() < 0.3:
                copy = copy[: base - random.randrange(0, 1 + base // 12)]
            rows.append((len(rows), " ".join(copy)))
    rows += [(len(rows) + i, t) for i, t in enumerate((None, "", " ", "one", "One", "two words"))]
    found = jaccard.near_classes(spark.createDataFrame(rows, "doc_id long, text string"), size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_classes(rows, size, percent)


def test_trie_walk_equals_set_arithmetic():
    random.seed(9)
    query = np.unique(np.array(random.sample(range(10**6), 300), np.uint64))
    others = []
    for _ in range(80):
        kept = random.sample(query.tolist(), random.randrange(200, 301))
        others.append(np.unique(np.array(kept + random.sample(range(10**6), random.randrange(0, 60)), np.uint64)))
    expected = [100 * len(np.intersect1d(query, o)) >= 85 * len(np.union1d(query, o)) for o in others]
    assert jaccard.linked(query, others, 85) == expected and any(expected) and not all(expected)


def test_sketches_rule_out_no_link(spark):
    random.seed(4)
    rows = []
    for size in (1, 6, 40, 200, 3000):
        one = random.sample(range(1 << 40), size)
        for _ in range(20):
            changed = random.randrange(0, 1 + size // 6)
            other = one[changed // 2 :] + random.sample(range(1 << 41, 1 << 42), changed)
            sets = [np.unique(np.array(s, np.uint64)) for s in (one, other)]
            both = len(np.intersect1d(*sets))
            links = 100 * both >= 85 * (len(sets[0]) + len(sets[1]) - both)
            rows.append((*(x for s in sets for x in (len(s), jaccard.sketch(s).tolist())), links))
    pairs = spark.createDataFrame(rows, "a_n_shingles long, a_bits array<long>, b_n_shingles long, b_bits array<long>, links boolean")
    passed = [(r.links, r.can) for r in pairs.selectExpr("links", f"{jaccard.can_link('a_', 'b_', 85)} AS can").collect()]
    assert (True, False) not in passed and (True, True) in passed and (False, False) in passed


def test_wide_sketches_rule_out_no_link(spark):
    random.seed(5)
    rows = []
    for size in (512, 520, 1020, 1030, 3000, 4100):
        one = random.sample(range(1 << 40), size)
        for _ in range(24):
            changed = random.randrange(0, 1 + size // 4)
            other = one[changed // 2 :] + random.sample(range(1 << 41, 1 << 42), random.choice((0, changed // 2, changed)))
            sets = [np.unique(np.array(s, np.uint64)) for s in (one, other)]
            both = len(np.intersect1d(*sets))
            links = 100 * both >= 80 * (len(sets[0]) + len(sets[1]) - both)
            wides = [jaccard.wide_sketch(s) for s in sets]
            rows.append((*(x for s, w in zip(sets, wides) for x in (len(s), None if w is None else w.tolist())), links))
            unlike = [len(w) for w in wides if w is not None]
            assert len(set(unlike)) < 2 or max(unlike) == 2 * min(unlike)
    assert any(a and b and len(a) != len(b) for _, a, _, b, _ in rows)
    pairs = spark.createDataFrame(rows, "a_n_shingles long, a_wide array<long>, b_n_shingles long, b_wide array<long>, links boolean")
    passed = [(r.links, r.can) for r in pairs.selectExpr("links", f"{jaccard.wide_can_link('a_', 'b_', 80)} AS can").collect()]
    assert (True, False) not in passed and (True, True) in passed
    # sets that share nothing are all ruled out, at any size
    other = [np.unique(np.array(random.sample(range(1 << 40), n), np.uint64)) for n in (520, 520, 1030, 1030, 9000, 9000)]
    apart = [(*(x for s in pair for x in (len(s), jaccard.wide_sketch(s).tolist())), False) for pair in zip(other[::2], other[1::2])]
    assert not spark.createDataFrame(apart, pairs.schema).filter(jaccard.wide_can_link("a_", "b_", 80)).count()


def test_near_classes_on_odd_tables(odd, empty):
    assert jaccard.near_classes(odd).count() == odd.count()
    kept = jaccard.one_of_each(odd)
    assert kept.columns == odd.columns and kept.filter("doc_id IN (4, 5)").count() == 1
    assert jaccard.near_classes(empty).count() == 0 and jaccard.one_of_each(empty).count() == 0


def test_classifiers_on_held_out_rows(spark):
    big = "/root/testdata/sf0.01"
    table, known = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet")
    def recall(rows, label, value):
        return np.mean([r.predicted == value for r in rows if r[label] == value])

    good = quality.quality_scores(table, known).join(known, "doc_id").filter("held_out AND quality IS NOT NULL").collect()
    bad = toxicity.toxicity_scores(table, known).join(known, "doc_id").filter("held_out").collect()
    print({(label, v): recall(rows, label, v) for rows, label in ((good, "quality"), (bad, "toxic")) for v in (0, 1)})
    assert recall(good, "quality", 1) > 0.95 and recall(good, "quality", 0) > 0.7
    assert recall(bad, "toxic", 0) > 0.95 and recall(bad, "toxic", 1) > 0.7
    told = language.languages(table).join(table.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in told]) > 0.95


def test_classifiers_on_odd_tables(spark, odd, empty, docs, labels):
    model, net, trees = quality.fit_quality(docs, labels), language.fit_language(docs, 60), toxicity.fit_toxicity(docs, labels)
    scored = quality.score_quality(odd, model).collect()
    assert len(scored) == odd.count() and all(0 <= r.score <= 1 for r in scored)
    told = language.predict_language(odd, net).collect()
    assert {r.lang_pred for r in told if r.doc_id in (0, 1, 2)} == {"und"} and len(told) == odd.count()
    assert all(0 <= r.score <= 1 for r in toxicity.score_toxicity(odd, trees).collect())
    nothing = labels.limit(0)
    assert {r.score for r in quality.score_quality(odd, quality.fit_quality(docs, nothing)).collect()} == {0.0}
    assert {r.score for r in toxicity.score_toxicity(odd, toxicity.fit_toxicity(docs, nothing)).collect()} == {0.0}
    assert {r.lang_pred for r in language.predict_language(odd, language.fit_language(empty)).collect()} == {"und"}
    assert quality.quality_scores(empty, labels).count() == 0 and language.languages(empty).count() == 0
    assert toxicity.toxicity_scores(empty, labels).count() == 0


HOSTILE = ["plain words here. " * 400, "BE,!! IST!! " * 900, "", "you\n" + "filler\t" * 3 + "dumm\n" * 700, "x" * 40_000, "日本語 テキスト\u3000" * 900,
           "\n".join(f"wörd{i % 91}" for i in range(4000)), "- - - you - - - " * 500]


def test_scores_do_not_depend_on_slices(docs, labels, monkeypatch):
    model, trees = quality.fit_quality(docs, labels), toxicity.fit_toxicity(docs, labels)
    texts = pa.array(HOSTILE)
    whole, features = model.probabilities(texts), trees.features(texts)
    for most in (1 << 20, 8192, 64):
        monkeypatch.setattr("epidw.llm.common.SLICE_BYTES", most)
        assert (model.probabilities(texts) == whole).all() and (trees.features(texts) == features).all()


def test_pipeline_batches_and_features_take_bounded_memory(spark):
    """Batches of 10,000 texts and slices of 256 KB took an executor of the pipeline over its 3000 MB in mixing."""
    default = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    texts = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "rows"])

    try:
        assert common.small_batches(spark) is spark
        found = texts.mapInArrow(sizes, "bytes long, rows long").collect()
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", default)
        mixing.with_membership(texts.withColumn("doc_id", F.lit(1)), subwords.SubwordModel.fit([]), BYTES)
        assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(common.BATCH_BYTES)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", default)
    assert max(r["bytes"] for r in found) <= 1.5 * common.BATCH_BYTES and sum(r["rows"] for r in found) == 4000
    model = subwords.SubwordModel.fit([("good words", 1), ("bad ones", 0)])
    column = pa.array(["some longer text of words, " * 70] * 1000)
    model.probabilities(column)  # what is kept from slice to slice is there before
    tracemalloc.start()
    model.probabilities(column)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20


def test_words_of_a_long_text_are_counted_once(monkeypatch):
    monkeypatch.setattr("epidw.llm.common.SLICE_BYTES", 4096)
    count = lambda data, starts, ends, bounds: np.array([[len(subwords.feature_buckets(data, bounds)[0])]])
    lines, word = "word\n" * 20_000, "é" * 50_000
    assert common.row_sums(pa.array([lines]), count, 1).tolist() == [[20_000]] and common.row_sums(pa.array([word]), count, 1).tolist() == [[1]]


def test_character_grams_stay_inside_words():
    def grams(text):
        words, buckets, owners = subwords.feature_buckets(np.frombuffer(text.encode(), np.uint8))
        return len(words), [len(o) for o in owners]

    assert grams("日本語") == (1, [1, 3, 2]) and grams("ab cd") == (2, [2, 4, 2]) and grams("a") == (1, [1, 1, 0]) and grams("") == (0, [0, 0, 0])
    assert Counter(subwords.features("ab CD")[0].tolist()) == Counter(subwords.features("cd\tab\n")[0].tolist())


def test_samples_are_bounded_in_bytes(spark):
    table = spark.createDataFrame([(i, "x" * 1000 if i % 2 else None) for i in range(60)], "doc_id long, text string")
    chosen = table.select("doc_id", F.lit(1).alias("v"))
    assert sum(len(t) for t, _ in common.sampled_texts(table, chosen, "v", 60, 5000)) == 5000
    assert len(common.sampled_texts(table, chosen, "v", 60)) == 60


def test_isotonic_is_monotone():
    xs, ys = toxicity.isotonic(np.array([1.0, 2, 3, 4, 4]), np.array([0.0, 1, 0, 1, 1]))
    assert (np.diff(ys) >= 0).all() and ys[0] == 0 and ys[-1] == 1


def test_mixing_meets_its_targets(spark, docs, labels, odd, empty):
    domains = queries.labelled_domains(docs, labels)
    weights = {"en": 0.4, "de": 0.2, "fr": 0.2, "es": 0.2}
    rows = mixing.mixing_rates(docs, domains, BYTES, weights=weights).collect()
    plain = Tokenizer.from_file(BYTES)
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert all(r.tokens == 1 + len(plain.encode(texts[r.doc_id], add_special_tokens=False).ids) for r in rows)
    target, reached = np.array(rows[0].target), np.array(rows[0].reached)
    again = sum(np.array(r.posterior) * r.tokens * r.rate for r in rows)
    assert np.abs(reached - target).max() <= 2e-4 * target.sum() and np.allclose(again, reached) and all(r.rate >= 0 for r in rows)
    assert rows[0].converged and rows[0].miss <= mixing.TOLERANCE
    # the same least squares by a plain solver over all rates at once
    share, tokens = np.array([r.posterior for r in rows]), np.array([r.tokens for r in rows], float)
    goal = np.array([weights[c] for c in sorted(weights)]) * tokens.sum()
    rate, step = np.ones(len(rows)), 1 / (tokens @ share)
    for _ in range(mixing.STEPS):
        miss = (rate * tokens) @ share - goal
        if np.abs(miss).max() <= mixing.TOLERANCE * tokens.sum():
            break
        rate = np.maximum(0, rate - share @ (miss * step))
    assert np.allclose(rate, [r.rate for r in rows], atol=1e-6)
    short = mixing.mixing_rates(docs, domains, BYTES, weights=weights, steps=0).first()
    assert not short.converged and short.miss > mixing.TOLERANCE
    mixed = mixing.mix(docs, domains, BYTES)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == docs.count()
    assert mixing.mixing_rates(odd, domains, BYTES).count() == odd.count() and mixing.mixing_rates(empty, domains, BYTES).count() == 0


def test_pipeline_stages(spark, docs, labels):
    found, tables = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        found = tables[name] = corpus_pipeline.written(stage(spark, found, SF), "test")
    good = {r.doc_id for r in quality.quality_scores(docs, labels).filter("predicted = 1").collect()}
    assert {r.doc_id for r in tables["quality classifier"].collect()} == good
    kept = {}
    for r in tables["quality classifier"].orderBy("doc_id").collect():
        text = re.sub(r"[\x20\x09-\x0D]", "", r.text)
        best = kept.get(text)
        kept[text] = r if best is None or len(r.text) > len(best.text) else best
    once = {r.doc_id: r.text for r in kept.values()}
    assert {r.doc_id for r in tables["exact dedup"].collect()} == set(once)
    classes = brute_classes(once.items(), 5, 80)
    assert {r.doc_id for r in tables["n-gram Jaccard join"].collect()} == {d for d, (_, c) in classes.items() if c == d}
    mixed = Counter(r.doc_id for r in tables["mixing to target weights"].collect())
    assert set(mixed) == {d for d, (_, c) in classes.items() if c == d}
    packed = Counter(r.doc_id for r in found.filter("piece = 0").collect())
    assert packed == mixed
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert tables[name].columns == docs.columns


def test_queries_are_registered():
    names = __spark_entry__.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
