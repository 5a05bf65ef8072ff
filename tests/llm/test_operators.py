"""The ten operators against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import textwrap
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from capsieve.llm import ann, bpe, fingerprints, graph, licenses, near_dup, packing, pii, quality, substring_dedup, warc
from capsieve.llm import words as W
from capsieve.llm.queries import VOCABULARY

WORD = re.compile(r"[^\x20\x09-\x0D]+")
R = random.Random(7)
PROSE = [" ".join(R.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()) + str(R.randint(0, 40)) for _ in range(n)) for n in (60, 90, 45, 200, 30)]


def changed(text, every):
    words = text.split()
    return " ".join(w + "x" if i % every == every - 1 else w for i, w in enumerate(words))


#: A drifting chain: each text is near its neighbour, the ends are not near each other.
CHAIN = [PROSE[3]]
for step in range(6):
    words = CHAIN[-1].split()
    for at in range(step * 5, step * 5 + 5):
        words[at] = f"new{step}n{at}"
    CHAIN.append(" ".join(words))

TEXTS = [
    None, "", " \t\n ", "one", "one two three", "One Two Three", PROSE[0], PROSE[0], PROSE[0].upper(), PROSE[1] + " \n " + PROSE[2], PROSE[2] + "\x0b" + PROSE[4],
    *CHAIN, changed(PROSE[1], 30), "x" * 50_000, "ab " * 5_000, "é́ ﬁ Σς <|endoftext|>日本 İ\x1c\x85z " + PROSE[4],
    "Released under the MIT License.\nmail a.b@c.de or 10.0.0.1\nALL RIGHTS RESERVED", "card 4111 1111 1111 1111, call +1 (988) 555-2485 a@b.c@d.e 1.2.3.4.5",
    PROSE[4] + " " + PROSE[4], changed(PROSE[0], 12),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 % 29, t, "en", 1.0, True, 5) for i, t in enumerate(TEXTS)]
    rows.append(rows[6])  # a repeated row
    return spark.createDataFrame(rows, "doc_id long, text string, component_id string, score double, row boolean, n_words int").repartition(3)


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def shingle_set(text, k=4):
    w = WORD.findall(lowered(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute_components(sets):
    label = {i: i for i in sets}
    changing = True
    while changing:
        changing = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= 80 * len(sets[a] | sets[b]) and label[b] < label[a]:
                    label[a], changing = label[b], True
    return label


def test_near_duplicates(docs, texts, empty):
    got, sets = by_id(near_dup.near_duplicates(docs)), {i: shingle_set(t) for i, t in texts.items()}
    want = brute_components(sets)
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}
    assert near_dup.near_duplicates(docs).count() == docs.count()
    assert near_dup.near_duplicates(empty).count() == 0


def test_near_duplicates_without_id(spark):
    got = near_dup.near_duplicates(spark.createDataFrame([(None, "a b c d"), (4, "a b c d")], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(None, None, True), (4, 4, True)}


def test_blocks_link_what_stars_miss(spark, monkeypatch):
    """Many partly alike texts in few buckets, compared in blocks of two."""
    monkeypatch.setattr(near_dup, "BLOCK", 2)
    rng, base = random.Random(3), [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for at in rng.sample(range(120), rng.choice([1, 3, 5, 6])):
            words[at] = f"v{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    got = by_id(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    want = brute_components({i: shingle_set(t) for i, t in rows})
    assert {i: r.component_id for i, r in got.items()} == want


def test_block_forest_is_exact():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets[5:]] for a in sets[:5]]
    assert near_dup._common(sets[:5], sets[5:]).astype(int).tolist() == want
    linked = np.zeros((6, 6), bool)
    for a, b in ((0, 1), (1, 2), (0, 2), (4, 5)):
        linked[a, b] = linked[b, a] = True
    assert len(near_dup._forest(linked)) == 3


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(100, 90), (90, 100)], "a long, b long")
    got = {r.id: r.component for r in graph.components(links).collect()}
    assert got == {i: 0 for i in range(51)} | {90: 90, 100: 90}


def brute_repeats(texts):
    seen, out = set(), {}
    for i in sorted(texts):
        w = WORD.findall(texts[i] or "")
        gone = [False] * len(w)
        for j in range(len(w) - 19):
            window = tuple(w[j : j + 20])
            if window in seen:
                gone[j : j + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(a for a, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), WORD.findall(kept))
    return out


def test_repeats(docs, texts, empty):
    rows = substring_dedup.remove_repeats(docs).collect()
    got = {r.row.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows}
    want = brute_repeats(texts)
    assert got == {i: w[:3] for i, w in want.items()} and len(rows) == docs.count()
    assert all(r.kept_text == (texts[r.row.doc_id] or "") for r in rows if not r.n_removed)
    assert all(WORD.findall(r.kept_text) == want[r.row.doc_id][3] for r in rows)
    assert rows[0].row.score == 1.0 and substring_dedup.remove_repeats(empty).count() == 0


def test_encoding(docs, texts, empty):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for i, r in by_id(bpe.encode(docs, VOCABULARY)).items():
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded) == (ids, tokenizer.decode(ids, skip_special_tokens=False))
    for i, r in by_id(bpe.digests(docs, VOCABULARY)).items():
        ids = tokenizer.encode(texts[i] or "", add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.digests(empty, VOCABULARY).count() == 0


def test_packing(docs, texts, empty):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack(docs, VOCABULARY).collect()
    for i in texts:
        ids = np.array([*tokenizer.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4")
        mine = sorted({(r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i})
        assert mine == [(p, s, min(2048, len(ids) - s), zlib.crc32(ids[s : s + 2048].tobytes())) for p, s in enumerate(range(0, len(ids), 2048))]
    sequences = {}
    for r in sorted(rows, key=lambda r: r.offset):
        assert sequences.get(r.sequence_id, 0) == r.offset
        sequences[r.sequence_id] = r.offset + r.length
    assert max(sequences.values()) <= 2048 and packing.pack(empty, VOCABULARY).count() == 0


def test_bound_and_best_fit():
    for seed in range(20):
        sizes = np.random.default_rng(seed).integers(1, 101, 60)
        bins, offsets = packing.best_fit(sizes, 100)
        assert np.bincount(bins, sizes).max() <= 100
        assert -(-sizes.sum() // 100) <= packing.lower_bound(sizes, 100) <= len(set(bins))
    assert packing.lower_bound(np.array([51, 51, 51]), 100) == 3


def test_rounds_exchange_open_bins(spark):
    rng = random.Random(2)
    pieces = spark.createDataFrame([(i, 0, 0, rng.randint(300, 1100), i) for i in range(600)], packing.PIECES)
    sizes = np.array([r.length for r in pieces.collect()])
    packed = packing.pack_pieces(pieces, group_size=40)
    in_one = len(set(packing.best_fit(sizes, 2048)[0].tolist()))
    assert packed.count() == 600 and packed.select("sequence_id").distinct().count() <= 1.02 * in_one
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("e")).where("n > 2048 OR n != e").count() == 0


def test_gaps_of_certified_groups_are_exchanged(spark):
    """Groups of short pieces all meet their own bound; their part-filled sequences still go together."""
    rng = random.Random(3)
    pieces = spark.createDataFrame([(i, 0, 0, rng.randint(5, 40), i) for i in range(8000)], packing.PIECES)
    bound = packing.lower_bound(np.array([r.length for r in pieces.collect()]), 2048)
    assert packing.pack_pieces(pieces, group_size=500).select("sequence_id").distinct().count() <= bound + 1


def test_repeated_rows_are_dealt_apart(spark):
    pieces = spark.createDataFrame([(None, 0, 0, 1500, 7)] * 400, packing.PIECES)
    packed = packing.pack_pieces(pieces, group_size=50).collect()
    assert len({r.sequence_id for r in packed}) == 400 and len({r.sequence_id >> 28 for r in packed}) > 1


def test_quality(docs, spark, empty):
    good = [(i, " ".join(R.choice(PROSE[0].split()) for _ in range(80)) + ".") for i in range(100, 250)]
    bad = [(i, "!! $$$ " * 30 + str(i)) for i in range(250, 400)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(None, 1), (5, None)], "doc_id long, quality int")
    corpus = spark.createDataFrame(good + bad + [(None, "a")], "doc_id long, text string").unionByName(docs.select("doc_id", "text"))
    rows = quality.quality(corpus, labels).collect()
    assert len(rows) == corpus.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [r for r in rows if r.held_out and 100 <= (r.doc_id or 0) < 400]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows if r.doc_id is not None)
    assert np.mean([r.predicted == (r.doc_id < 250) for r in held]) > 0.95
    assert {r.score for r in quality.quality(docs, labels.limit(0)).collect()} == {0.5}
    assert quality.quality(empty, labels).count() == 0
    assert quality.with_scores(docs, quality.grow(np.zeros((0, 1)), np.zeros(0))).select("row.*").columns == docs.columns


def test_fingerprints(docs, texts, empty, spark):
    rows = fingerprints.edit_likeness(docs.dropDuplicates(["doc_id"])).collect()
    order = sorted(texts)
    following = dict(zip(order, [*order[1:], order[0]], strict=True))
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    for r in rows:
        a, b = texts[r.doc_id] or "", texts[following[r.doc_id]] or ""
        half = len(a) // 2
        edited = a[: len(a) - half] + b[:half]
        assert (r.n_chars, r.edited_sha256) == (len(a), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == plain[r.doc_id] and 0 <= r.near_edited <= 1
        pairs = [(r.fingerprint[i : i + 4], plain[following[r.doc_id]][i : i + 4]) for i in range(0, 256, 4)]
        assert r.near_next == pytest.approx(np.mean([x == y for x, y in pairs]))
    assert len(rows) == len(texts) and fingerprints.edit_likeness(empty).count() == 0
    one = fingerprints.edit_likeness(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).first()
    assert one.near_next == 1.0


def test_order_of_words_counts(spark):
    words = PROSE[3].split()
    rows = [(1, " ".join(words)), (2, " ".join(words[100:] + words[:100])), (3, changed(PROSE[3], 60))]
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    like = lambda a, b: np.mean([got[a][i : i + 4] == got[b][i : i + 4] for i in range(0, 256, 4)])
    assert like(1, 3) > 0.6 and like(1, 2) < like(1, 3)


PLAIN = (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(text):
    out = []
    for kind, pattern in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            luhn = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0
            if (kind == 0 or kind == 1 and all(int(p) <= 255 for p in m.group().split(".")) or kind == 2 and 12 <= len(digits) <= 19 and luhn
                    or kind == 3 and 9 <= len(digits) <= 15):
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_personal_data(docs, texts, empty, spark):
    extra = ["x@b.cd%e@f.g", "1.2.3.4.5.6.7.8 0000255.1.1.1 256.1.1.1", "a@" + ".b" * 3000, "1" * 3000, "é😀 a.b@c.de"]
    corpus = docs.unionByName(spark.createDataFrame([(100 + i, t) for i, t in enumerate(extra)], "doc_id long, text string"), allowMissingColumns=True)
    every = texts | {100 + i: t for i, t in enumerate(extra)}
    rows = pii.scan(corpus).collect()
    for r in rows:
        want = ",".join(f"{pii.KINDS[k]}:{a}:{e}" for a, k, e in brute_base(every[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert len(rows) == corpus.count() and pii.scan(empty).count() == 0
    clean = by_id(pii.sanitised(docs))
    assert all(clean[i].text == t for i, t in texts.items() if not brute_base(t))
    assert any("[EMAIL]" in r.text and "[IP]" in r.text for r in clean.values()) and pii.sanitised(docs).columns == docs.columns


def test_revealing_terms(spark):
    rows = [(1, "my friend zorblax writes from a@b.cd every day"), (2, "today zorblax wrote from a@b.cd again my day"), (3, "my day was long every time"), (4, "my friend left")]
    got = by_id(pii.scan(spark.createDataFrame(rows, "doc_id long, text string")))
    assert "removed:10:17" in got[1].spans and "removed:6:13" in got[2].spans and not got[3].spans and not got[4].spans
    text = by_id(pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")))[1].text
    assert "zorblax" not in text and "[EMAIL]" in text and "friend" in text


def test_revealing_terms_wherever_they_stand(spark):
    far = " and so on" * 20
    rows = [(1, f"zorblax{far} a@b.cd said Zorblax"), (2, f"a@b.cd{far} from zorblax now"), (3, f"zorblax{far}{far} a@b.cd"), (4, "nothing else"),
            *[(i, f"zorblax{far} and a@b.cd {'abcdefgh'[i - 5]}") for i in range(5, 13)], (13, "only zorblax here"), (14, None),
            (20, f"quuxly{far} q@r.st one"), (21, f"q@r.st{far} quuxly two quuxly"), (22, "quuxly q@r.st"), (23, "quuxly alone")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got, text = by_id(pii.scan(table)), by_id(pii.sanitised(table))
    # 11 of 12 documents with the name hold the address: it goes from all of them, the one without the address too
    assert not any("zorblax" in (r.text or "").lower() for r in text.values()) and got[13].spans == "removed:5:12"
    assert got[1].spans.count("removed") >= 2 and text[4].text == "nothing else" and text[14].text is None
    # 3 of 4: generalised at every place of the documents that hold the address
    assert text[21].text.count("[TERM]") == 2 and "[TERM]" in text[20].text and "quuxly" not in text[22].text


def brute_terms(rows):
    """(doc_id, kind, term) by the rule of the docstring, every term against every entity."""
    letters = re.compile(r"[^\W\d_]{3,}")
    seen = {}
    for i, text in rows:
        base = brute_base(text)
        masked = list(text or "")
        for a, _, e in base:
            masked[a:e] = " " * (e - a)
        seen[i] = ("".join(masked), {(k, (text or "")[a:e].lower()) for a, k, e in base}, [w.lower() for w in letters.findall("".join(masked))], text)
    with_entity, with_term, out = {}, {}, set()
    for i, (_, entities, words, _) in seen.items():
        for x in entities:
            with_entity.setdefault(x, set()).add(i)
        for t in words:
            with_term.setdefault(t, set()).add(i)
    for x, de in with_entity.items():
        if len(de) > (len(rows) + pii.PRIOR) * 2.0**-pii.SURPRISE:
            continue
        for t, dt in with_term.items():
            both = de & dt
            around = [(w[j - 1] if j else "", w[j + 1] if j + 1 < len(w) else "") for i in both for w in [seen[i][2]] for j in range(len(w)) if w[j] == t]
            share = len(both) / len(dt)
            if (len({seen[i][3] for i in both}) < 2 or len({a for a, _ in around}) < 2 or len({b for _, b in around}) < 2 or len(both) < pii.COVER * len(de)
                    or share * len(rows) < 2**pii.GAIN * len(de) or share < 2**-pii.GENERALISE):
                continue
            out |= {(i, "removed", t) for i in dt} if share >= 2**-pii.REMOVE else {(i, "term", t) for i in both}
    return {(i, k, t) for i, k, t in out if k == "removed" or (i, "removed", t) not in out}


def found_terms(spark, rows):
    text = dict(rows)
    got = pii.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    spans = [(r.doc_id, *s.split(":")) for r in got for s in r.spans.split(",") if s]
    return {(i, k, text[i][int(a):int(e)].lower()) for i, k, a, e in spans if k in ("term", "removed")}


def test_disclosing_terms_against_brute_force(spark):
    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ban", "dor", "kel", "mir", "tov") for b in ("ix", "um", "ea", "os")]
    rows = []
    for i in range(160):
        text = [rng.choice(words) for _ in range(rng.randint(2, 14))]
        who = rng.randint(0, 30)
        if who < 10:
            text.insert(rng.randint(0, len(text)), f"p{who}@mail.example")
        if who < 12 and rng.random() < 0.9:
            text.insert(rng.randint(0, len(text)), f"Person{'abcdefghijkl'[who]}")
        elif who > 25:
            text.insert(rng.randint(0, len(text)), f"Person{rng.choice('abcdef')}")
        rows.append((i, " ".join(text)))
    rows += [(200 + i, rows[3][1]) for i in range(5)] + [(300, None), (301, "")]
    want = brute_terms(rows)
    assert found_terms(spark, rows) == want and {k for _, k, _ in want} == {"term", "removed"}


@pytest.mark.parametrize("share", [12, 19, 20])
def test_footers_stay(spark, share):
    """A contact address in most documents makes no word of theirs private, nor the words of its own phrase."""
    rng = random.Random(share)
    words = "harvest moved slowly while river traffic grew and local markets stayed calm under heavy rain".split()
    rows = [(i, f"Report {i}: " + " ".join(rng.sample(words, 8)) + (", write to our editors at desk@news.example" if i < share else "")) for i in range(20)]
    clean = by_id(pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: r.text for i, r in clean.items()} == {i: t.replace("desk@news.example", "[EMAIL]") for i, t in rows}
    assert found_terms(spark, rows) == brute_terms(rows) == set()


def common_entity_rows(n, share, rng):
    """A share of the texts names an address; names stand nearly only, often or not beside it, words anywhere."""
    words = [f"{a}{b}" for a in ("ban", "dor", "kel", "mir", "tov") for b in ("ix", "um", "ea", "os")]
    rows = []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(4, 12))]
        holds = rng.random() < share
        put = [("Zorblax", 0.7, 0.01), ("Quuxly", 0.6, 0.2), ("Plinthe", 0.3, 0.3), ("Rarely", 0.05, 0.0)]
        text += [name for name, inside, outside in put if rng.random() < (inside if holds else outside)]
        rng.shuffle(text)
        rows.append((i, " ".join([*text, "desk@news.example"] if holds else text)))
    return rows


@pytest.mark.parametrize("share", [0.2, 0.45, 0.6, 0.8])
def test_common_entities_are_not_left_out(spark, monkeypatch, share):
    """An address in 49 to 195 of 240 documents is disclosed by the terms that inform about it, by the rule without any bound on the entity."""
    rows = common_entity_rows(240, share, random.Random(int(share * 100)))
    with monkeypatch.context() as unbounded:
        unbounded.setattr(pii, "SURPRISE", -100.0)
        want = brute_terms(rows)
    assert found_terms(spark, rows) == want
    assert {t for _, _, t in want} == {0.2: {"zorblax"}, 0.45: {"zorblax", "quuxly"}, 0.6: {"zorblax", "quuxly"}, 0.8: set()}[share]


def test_near_copies_lose_no_words(spark):
    rows = [(1, "quarzel umbrod vintex a@b.cd plinth"), (2, "quarzel umbrod vintex a@b.cd plinth two"), *[(i, f"other text number {i}") for i in range(3, 40)]]
    assert found_terms(spark, rows) == brute_terms(rows) == set()


def test_directories_are_bounded(spark):
    """Many addresses in the same documents count as one entity."""
    page = " ".join(f"u{i}@mail.example" for i in range(1500))
    rows = [(i, f"Zorblax {'abc'[i]} {page} list{'abc'[i]} Zorblax end{'xyz'[i]} now") for i in range(3)] + [(i, f"some text {i} here") for i in range(3, 60)]
    got = found_terms(spark, rows)
    assert {(i, "removed", "zorblax") for i in range(3)} <= got


def test_classes_of_generalised_terms(spark):
    rows = [(1, "Quuxly one q@r.st"), (2, "q@r.st saw QUUXLY two"), (3, "the quuxly q@r.st three"), (4, "Quuxly alone"), *[(i, f"other {i}") for i in range(5, 20)]]
    text = by_id(pii.sanitised(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [text[i].text for i in (1, 2, 3, 4)] == ["[NAME] one [EMAIL]", "[EMAIL] saw [ACRONYM] two", "the [TERM] [EMAIL] three", "Quuxly alone"]


def test_licences(docs, empty):
    got = {(r.doc_id, r.line_no, r.license) for r in licenses.scan(docs).collect()}
    assert {name for *_, name in got} == {"MIT", "All-rights-reserved"}
    assert licenses.scan(empty).count() == 0 and licenses.scan(docs, {}).count() == 0


def test_licences_wrapped_and_within_lines(spark):
    mit, bsd = licenses.TEMPLATES["MIT"][1], licenses.TEMPLATES["BSD"][0]
    rows = [(1, "Copyright (c) 2024 Example Inc. All rights reserved."), (2, "Text and images by J. Doe, 2024. Licensed under CC BY 4.0."),
            (3, "a title\n" + "\n".join(textwrap.wrap(bsd, 70)) + "\nmore words"), (4, "x y\n\n" + "\n".join(textwrap.wrap(mit, 70))),
            (5, "All rights reserved.\nno"), (6, "rights of all, reserved for the work"), (7, None)]
    got = sorted((r.doc_id, r.line_no, r.license, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 0, "All-rights-reserved", 1.0), (2, 0, "CC-BY-4.0", 1.0), (3, 1, "BSD", 1.0), (4, 2, "MIT", 1.0), (5, 0, "All-rights-reserved", 1.0)]


def brute_licences(text, t=0.8):
    """(line_no, license, dice): every line and every window of the text against every template."""
    norm = lambda line: re.findall("[a-z0-9]+", lowered(line))
    templates = [(name, set(licenses.bigrams(x))) for name in sorted(licenses.TEMPLATES) for x in licenses.TEMPLATES[name]]
    dice = lambda a, b: 2.0 * len(a & b) / (len(a) + len(b))
    words, own = [], {}
    for i, line in enumerate((text or "").split("\n")):
        w = norm(line)
        words += [(x, i) for x in w]
        pairs = {f"{a} {b}" for a, b in zip(w, w[1:])}
        best = min(((-dice(pairs, b), name) for name, b in templates), default=(0, "")) if pairs else (0, "")
        if -best[0] >= t:
            own[i] = (best[1], -best[0])
    grams = [(f"{a} {b}", i, j) for (a, i), (b, j) in zip(words, words[1:])]
    windows = []
    for name, b in templates:
        for at in range(len(grams)):
            if grams[at][0] not in b:
                continue
            found = []
            for end in range(at, min(len(grams), at + int(len(b) * (2 - t) / t + 1e-9))):
                if grams[end][0] in b:
                    found.append((-dice({g for g, *_ in grams[at:end + 1]}, b), at, name, end, grams[at][1], grams[end][2]))
            if found and -min(found)[0] >= t:
                windows.append(min(found))
    windows = [w for w in windows if not any(i in own for i in range(w[4], w[5] + 1))]
    kept = [w for w in set(windows) if not any(v < w and v[1] <= w[3] and w[1] <= v[3] for v in windows)]
    return sorted([(i, *x) for i, x in own.items()] + [(w[4], w[2], -w[0]) for w in kept])


def test_licences_against_brute_force(spark):
    rng = random.Random(11)
    notices = [x for texts in licenses.TEMPLATES.values() for x in texts]
    rows = []
    for i in range(60):
        pieces = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(notices).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                at = rng.randrange(len(words))
                words[at:at + 1] = rng.choice([[], ["other"], [words[at], "more"], [words[at].upper()]])
            pieces += [" ".join(rng.choice("the work of a new license under this program".split()) for _ in range(rng.randint(0, 5))), " ".join(words)]
        text = rng.choice([" ", "\n", ". ", " -- "]).join(pieces)
        rows.append((i, "\n".join(textwrap.wrap(text, rng.choice([30, 70, 500])))))
    rows += [(100, None), (101, ""), (102, "license"), (103, "All rights reserved. foo1 bar1 " * 300), (104, rows[0][1])]
    got = {}
    for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        got.setdefault(r.doc_id, []).append((r.line_no, r.license, round(r.dice, 9)))
    for i, text in rows:
        assert sorted(got.get(i, [])) == sorted((a, b, round(d, 9)) for a, b, d in brute_licences(text)), text
    assert len(got[103]) == 300


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 8)) + rng.integers(0, 4, (700, 1)) * 2
    x[300:340] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] * 8), (1150, [None] + [1.0] * 7), (1200, [1.0]), (None, [1.0] * 8), (50, x[50].tolist())]
    return x, spark.createDataFrame([(*r, 3) for r in rows], "vec_id long, embedding array<float>, score int")


def test_nearest(vectors):
    x, table = vectors
    x = x.astype(np.float32).astype(np.float64)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    got = {}
    for r in ann.nearest(table).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = 0
    for q in range(0, 700, 50):
        near = unit @ unit[q]
        near[q] = -9
        near = np.round(near, 12)
        want = np.lexsort((np.arange(700), -near))[:5]
        hits += len(set(want.tolist()) & {v for v, _ in got[q].values()})
        assert all(s == pytest.approx(unit[v] @ unit[q]) for v, s in got[q].values())
    assert set(got) == set(range(0, 700, 50)) and hits >= 0.9 * 70 and sorted(got[0]) == [1, 2, 3, 4, 5]
    assert [got[0][r][0] for r in range(1, 6)] == [300, 301, 302, 303, 304]
    assert ann.nearest(table.limit(0)).count() == 0 and ann.nearest(table.where("vec_id = 50")).count() == 0


def test_calibration_without_copies_and_fit():
    rng = np.random.default_rng(3)
    x = ann._unit(rng.normal(size=(3000, 24)))
    copies = ann._unit(np.repeat(x[:1], 1500, axis=0))
    tree, visits = ann.planned(rng.permutation(np.vstack([x, copies])), 5, ann.RECALL)
    of, fresh = tree.assign(x), ann._unit(rng.normal(size=(300, 24)))
    hits = [np.isin(of[np.argsort(-(x @ q))[:5]], tree.visit(q, visits)).mean() for q in fresh]
    assert ann.RECALL >= 0.98 and np.mean(hits) >= 0.98 and visits < tree.leaves


@pytest.fixture(scope="module")
def pages(spark):
    long = "<p>" + "word " * 50
    rows = [(5, "http://www.Example.com/a?b=c", long), (3, "https://example.com/\nx", long), (9, None, long), (7, "bad url", None), (8, "http://a.b/", "short"), (1, "http://a.b/", "short"),
            (None, "http://a.b/", long), (5, "http://www.Example.com/a?b=c", long), (12, "http://ä.example/ü", "ü" * 60)]
    return spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string")


def test_warc(pages):
    rows = warc.round_trip(pages).collect()
    digest = {r.page_id: hashlib.sha256((r.html or "").encode()).hexdigest() for r in pages.collect()}
    got = sorted((r.page_id if r.page_id is not None else -1, r.payload_digest == digest[r.page_id], r.record_type, r.refers_to) for r in rows)
    assert got == sorted([(5, True, "revisit", 3), (3, True, "response", None), (9, True, "revisit", 3), (7, True, "response", None), (8, True, "response", None),
                          (1, True, "response", None), (-1, True, "response", None), (5, True, "revisit", 3), (12, True, "response", None)], key=lambda t: (t[0], str(t)))
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_lookup_over_many_blocks(pages, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 2)
    shards = warc.write_archives(pages)
    key = pages.where("page_id = 5").select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    found = warc.read(warc.lookup(key, shards)).collect()
    assert len(found) == 2 and {r.page_id for r in found} == {5}
    assert warc.lookup(key.withColumn("key", F.lit("none")), shards).count() == 0


# ---------------------------------------------------------------- hashes of words

def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_no_constructed_collisions(spark):
    """Two words of 2,048 letters, and two passages of as many words, that share a polynomial hash modulo 2^64 for every base."""
    one, two = thue_morse(2048)
    found = W.find(np.frombuffer(f"{one} {two}".encode(), np.uint8), np.array([0, 4097]))
    assert len(set(found.hashes().tolist())) == 2
    prose = [" ".join({"a": "left", "b": "right"}[c] for c in x) for x in (one, two)]
    rows = [(1, one), (2, two), (3, f"{one} x y z"), (4, f"{two} x y z"), (5, prose[0]), (6, prose[1])]
    table, texts = spark.createDataFrame(rows, "doc_id long, text string"), dict(rows)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert {r.doc_id: r.ids for r in bpe.encode(table, VOCABULARY).collect()} == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in rows}
    assert {r.doc_id: r.component_id for r in near_dup.near_duplicates(table).collect()} == {i: i for i in (1, 2, 3, 4, 5)} | {6: 5}
    want = brute_repeats(texts)
    got = {r.row.doc_id: (r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(table).collect()}
    assert got == {i: w[1:3] for i, w in want.items()}


def test_hashes_of_short_words_differ():
    words = sorted({bytes(R.choices(range(33, 127), k=n)) for n in (1, 2, 3, 7, 8, 9, 15, 16, 17, 40, 256, 257, 300) for _ in range(300)})
    text = b" ".join(words)
    found = W.find(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert len(set(found.hashes().tolist())) == len(words)
    again = W.find(np.frombuffer(b"  " + text, np.uint8), np.array([0, len(text) + 2]))
    assert again.hashes().tolist() == found.hashes().tolist()
    upper = W.find(np.frombuffer(text.upper(), np.uint8), np.array([0, len(text)]))
    assert upper.hashes(True).tolist() == found.hashes(True).tolist()


def test_fingerprints_of_text_without_spaces(spark):
    rng = random.Random(8)
    text = "".join(chr(rng.randint(0x4E00, 0x4E80)) for _ in range(170))
    rows = [(1, text), (2, text[:80] + "x" + text[81:]), (3, "".join(rng.sample(text, len(text)))), (4, "y" * 5000)]
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    same = lambda a, b: sum(got[a][i:i + 4] == got[b][i:i + 4] for i in range(0, 256, 4))
    assert same(1, 2) > 45 and same(1, 3) < 10 and same(1, 4) == 0
