"""Text operators against libraries, brute force and round trips, on small awkward tables."""

import collections
import hashlib
import re
import tracemalloc
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from placeweave.llm import bpe, huffman, jaccard, langid, licenses, neighbours, packing, pii, toxicity, winnow

WORDS = "the of and stone river light house green water cloud paper silver morning walk sing".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS, n))


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    base = prose(rng, 120)
    texts = [base, base, base + " extra", base.replace("stone", "brick", 1), base.upper(), "", None, "   \t\n", "one", "one two three", prose(rng, 4000)]
    texts += [prose(rng, int(n)) for n in rng.integers(5, 90, 20)]
    texts += ["Hello wörld  it's  don't 1234 ñÑ <|endoftext|> 上海！ ﬁ  \n x", "ΟΔΟΣ Σ İ ſ 'S", "a\x1cb\x1fc d\x85e\xa0f", "é café ﷺ", "x" * 3000 + "." * 300, "१२३ ⅷ ½ 🎉", "12345 !!! ???"]
    return [(i, t, "en" if i % 2 else "xx", "s", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("ids", F.lit("clash")).withColumn("keys", F.lit(1))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.vocabulary_path())


def test_bpe_is_the_librarys(docs, rows, library, empty):
    got = {r.doc_id: r for r in bpe.encode_documents(docs).collect()}
    digests = {r.doc_id: r for r in bpe.document_digests(docs).collect()}
    for i, t, *_ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert got[i].ids == ids and got[i].decoded == text
        assert digests[i].n_tokens == len(ids)
        assert digests[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = {r.doc_id: r.decoded for r in bpe.decode_documents(bpe.encode_documents(docs)).collect()}
    assert back == {i: r.decoded for i, r in got.items()}
    assert bpe.document_digests(empty).count() == 0


def test_packing_is_whole_and_tight(docs, rows, library, empty):
    got = [r.asDict() for r in packing.pack_documents(docs, 64, 0).collect()]
    pieces = collections.defaultdict(list)
    for r in got:
        pieces[r["doc_id"]].append(r)
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        mine = sorted(pieces[i], key=lambda r: r["piece"])
        assert [(r["start"], r["length"]) for r in mine] == [(k, min(64, len(ids) - k)) for k in range(0, len(ids), 64)]
        assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) for r in mine)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) <= -(-sum(r["length"] for r in got) // 64) + 1
    assert packing.pack_documents(empty).count() == 0


def test_local_search_empties_a_bin():
    sizes = np.array([6, 6, 5, 5, 4, 4])  # two bins of ten hold 5+5 and 6+4, 6+4
    start = [[0, 2 - 2 + 4], [1], [2], [3], [5]]
    done = packing.local_search([list(b) for b in start], sizes, 10)
    assert sorted(i for b in done for i in b) == list(range(6)) and len(done) == 3
    assert packing.local_search([], sizes, 10) == []


def test_huffman_lengths_and_codes():
    c = np.random.default_rng(0).integers(1, 1000, 300)
    assert (huffman.code_lengths(c) * c).sum() == sum(a * b for a, b in zip(huffman.plain_lengths(c.tolist()), c.tolist(), strict=True))
    steep = huffman.code_lengths(np.array([2**i for i in range(30)]), 6)
    assert steep.max() <= 6 and sum(2.0 ** -int(x) for x in steep) <= 1
    assert huffman.code_lengths(np.array([0, 7, 0])).tolist() == [0, 1, 0] and huffman.code_lengths(np.zeros(4, int)).sum() == 0
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    n = huffman.code_lengths(np.bincount(ids, minlength=1 << 16))
    data = huffman.write_block(np.array([3, 9]), np.array([4000, 1000]), ids, n, huffman.canonical(n))
    d, s, back = huffman.read_block(data, huffman.decode_table(n))
    assert d.tolist() == [3, 9] and s.tolist() == [4000, 1000] and (back == ids).all()


def test_token_files(docs, rows, library, empty):
    at = 0
    got = {r.doc_id: r for r in huffman.token_file_digests(docs).collect()}
    for i, t, *_ in rows:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert huffman.token_file_digests(empty).count() == 0


def shingles(t, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def linked(sets, percent):
    """Smallest id reachable, by comparing all pairs."""
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80), (2, 50)])
def test_jaccard_is_brute_force(docs, rows, k, percent):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, k, percent).collect()}
    assert got == linked({i: shingles(t, k) for i, t, *_ in rows}, percent)


def test_jaccard_in_many_fragments_and_blocks(spark, monkeypatch):
    """Short segments, blocks of two pairs, several groups; families of edited texts that share passages with others."""
    for name, value in {"SEGMENT_KEYS": 9, "BLOCK": 2, "GROUP_BYTES": 200, "GROUPS": 3}.items():
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(12)
    passages, texts = [prose(rng, 30) for _ in range(4)], []
    for f in range(12):
        base = (prose(rng, 40) + " " + passages[f % 4] + " " + passages[(f + 1) % 4]).split()
        for _ in range(9):
            own = list(base)
            for at in rng.integers(0, len(own), rng.integers(0, 5)):
                own[at] = f"w{rng.integers(0, 30)}"
            texts.append(" ".join(own))
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for k, percent in ((3, 85), (2, 60)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(d, k, percent).collect()}
        assert got == linked({i: shingles(t, k) for i, t in enumerate(texts)}, percent)


def test_first_places():
    new, refs, times = jaccard._first_places(np.array([5, 9, 5, 7, 9, 5], np.uint64))
    assert new.tolist() == [True, True, False, True, False, False] and refs.tolist() == [0, 1, 0] and times.tolist() == [3, 2, 1]


def test_keep_one(spark, docs, rows, empty):
    kept = jaccard.keep_one(docs, 5, 80)
    ids = {r.doc_id for r in kept.collect()}
    assert 0 in ids and not ids & {1, 2, 4} and {5, 6, 7} <= ids and kept.columns == docs.columns
    assert jaccard.keep_one(empty).count() == 0
    odd = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f"), (1, "g h i j k l"), (None, None), (2, "")], "doc_id long, text string")
    assert jaccard.jaccard_components(odd).count() == 6
    assert sorted(((r.doc_id, r.text) for r in jaccard.keep_one(odd).collect()), key=repr) == [(1, "a b c d e f"), (1, "g h i j k l"), (2, ""), (None, None)]


def test_winnowing(docs, rows, empty):
    rng = np.random.default_rng(0)
    for w in (1, 2, 3, 5, 16):
        for n in (1, 5, 30, 100):
            t = rng.integers(0, 2, n).astype("<u4")
            h = winnow.kgram_hashes(t, 3)
            size = min(w, len(h))
            want = sorted({max(range(j, j + size), key=lambda i: (-int(h[i]), i)) for j in range(len(h) - size + 1)})
            assert winnow.winnow(t, 3, w)[1].tolist() == want
    got = {r.doc_id: r for r in winnow.edit_likeness(docs).collect()}
    text = {i: t or "" for i, t, *_ in rows}
    for i, t in text.items():
        after = text[(i + 1) % len(text)]
        n = len(t) // 4
        assert got[i].n_chars == len(t)
        assert got[i].edited_sha256 == hashlib.sha256((t[: len(t) - n] + after[:n]).encode()).hexdigest()
    assert got[0].fingerprint == got[1].fingerprint and got[0].near_next == 1.0
    assert winnow.edit_likeness(empty).count() == 0


def test_shared_passages_share_a_fingerprint():
    rng = np.random.default_rng(3)
    passage = "".join(rng.choice(list("abcdefgh "), winnow.K + winnow.WINDOW - 1))
    a, b = (winnow.winnow(winnow.code_points("".join(rng.choice(list("xyz "), 80)) + passage + "".join(rng.choice(list("uvw "), 50))))[0] for _ in range(2))
    assert set(a.tolist()) & set(b.tolist())


def test_licenses(spark, empty):
    texts = ["Released under the MIT License.", "mit\nlicense and MIT  license", "nothing here", None, "", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated files", "General Public License; the Apache License", "emit license"]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(d).collect()}
    for i, t in enumerate(texts):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        assert (got[i].n_words, got[i].n_base, got[i].base_labels) == (len(w), len(places), ",".join(sorted({x for _, x in places})))
        assert (got[i].first_word, got[i].last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
    assert got[5].labels == "mit" and got[5].n_base == 0 and got[5].score >= 0.8 and got[2].score == 0
    assert licenses.scan(empty).count() == 0


def test_licenses_across_lines(spark):
    long = [(label, t) for label, t, _ in licenses.TEMPLATES if len(t.split()) >= 16]
    texts = [" * " + "\n * ".join(re.findall(r".{1,40}(?:\s|$)", t)) for _, t in long]
    texts += ["released " + "word " * 50 + "under " + "word " * 50 + "the " + "word " * 50 + "license", "Released under\nthe MIT\nLicense\nx\nreleased under the MIT license", "Licensed under CC BY-NC 4.0."]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [(label, got[i].score) for i, (label, _) in enumerate(long) if label in got[i].labels.split(",")] == [(label, 1.0) for label, _ in long]
    assert got[len(long)].labels == "" and [(b.line, b.label, b.share) for b in got[len(long) + 1].blocks] == [(0, "mit", 1.0), (4, "mit", 1.0)]
    assert [(b.line, b.label, b.share) for b in got[len(long) + 2].blocks] == [(0, "cc", 1.0)]
    others = ["This code is released under the GPL license.", "The film was released under the license of the studio", "Licensed under the license, version 2.0", "this work is licensed under the new general public rules, version 3", None]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame([*enumerate(others), (None, "MIT license"), (None, "MIT license")], "doc_id long, text string")).collect()}
    assert got == {0: "gpl", 1: "", 2: "", 3: "", 4: "", None: "mit"}


def test_a_notice_in_a_very_long_text(spark):
    notice = next(t for label, t, _ in licenses.TEMPLATES if label == "mit" and len(t.split()) > 100)
    text = "software the of and in license permission " * 60_000 + notice.replace(" ", " \n") + " the software is" * 60_000
    got = licenses.scan(spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")).collect()
    assert [(r.labels, r.score, r.n_words) for r in got] == [("mit", 1.0, 600_000 + len(notice.split()))] * 2


def test_license_windows_are_brute_force():
    rng = np.random.default_rng(6)
    t = licenses.Templates(licenses.TEMPLATES, 0.8)
    for _ in range(60):
        texts = []
        for _ in range(3):
            words = rng.integers(-1, len(t.words), 30).tolist()
            for k in rng.integers(0, len(t.sizes), 2):
                own = [t.words.index(w) for w in licenses.TEMPLATES[k][1].split()]
                for at in rng.integers(0, len(own), rng.integers(0, 6)):
                    own[at] = -1
                words[int(rng.integers(0, 30)) : 0] = own + own[: int(rng.integers(0, len(own)))]
            texts.append(words)
        first = np.cumsum([0, *map(len, texts)])
        got = t.windows(np.concatenate(texts), first)
        want = collections.defaultdict(float)
        for d, words in enumerate(texts):
            for k, (label, text, own) in enumerate(licenses.TEMPLATES):
                whole, must = collections.Counter(t.words.index(w) for w in text.split()), {t.words.index(w) for w in own.split()}
                blocks = [collections.Counter(words[i : i + t.widths[k]]) for i in range(len(words))]
                most = max((sum((b & whole).values()) for b in blocks if must <= set(b)), default=0)
                if most >= t.needs[k]:
                    want[d, label] = max(want[d, label], most / t.sizes[k])
        best = collections.defaultdict(float)
        for d, a, z, label, share in got:
            inside = collections.Counter(texts[d][a - first[d] : z + 1 - first[d]])
            assert any(name == label and z - a < t.widths[k] and sum((inside & collections.Counter(t.words.index(w) for w in text.split())).values()) / t.sizes[k] == share for k, (name, text, _) in enumerate(licenses.TEMPLATES))
            best[d, label] = max(best[d, label], share)
        assert best == want


def test_language(spark, empty):
    rng = np.random.default_rng(1)
    other = "und der nicht über schön straße grün wasser haus".split()
    rows = [(i, " ".join(rng.choice(WORDS if i % 2 else other, 30)), "en" if i % 2 else "de") for i in range(300)] + [(900, None, "en"), (901, "123 !!", "en"), (902, "", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.predict_held_out(d).collect()}
    right = [got[i].lang_pred == lang for i, _, lang in rows[:300] if got[i].held_out]
    assert len(right) > 40 and np.mean(right) > 0.98
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (900, 901, 902))
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= got[i].score <= 1 for i in got)
    kept = langid.keep_known(d, langid.train(d))
    assert {r.doc_id for r in kept.collect()} == set(range(300)) and kept.columns == d.columns
    assert langid.predict_held_out(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert langid.predict_held_out(spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string").withColumn("lang", F.col("lang").cast("string"))).first().lang_pred == "und"


def test_temperature_sharpens_what_is_right():
    y = np.array([0, 1] * 20)
    sure = np.where(np.arange(2) == y[:, None], 1.0, 0.0)
    assert langid.temperature(sure, y) < 1 < langid.temperature(20 * np.where(np.arange(2) == (y * 0)[:, None], 1.0, 0.0), y)


def test_toxicity(spark):
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, 25) + (" idiot moron" if i % 3 == 0 else "")) for i in range(360)] + [(900, None), (901, ""), (902, "you 1d1ot"), (903, "i d i o t"), (904, "mooooron")]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit(1))
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(360)] + [(None, 1), (5, None)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.score_held_out(d, labels).collect()}
    assert all(got[i].predicted == int(i % 3 == 0) for i in range(360))
    assert [got[i].predicted for i in range(900, 905)] == [0, 0, 1, 1, 1]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in got)
    kept = toxicity.keep_clean(d, toxicity.train(d, labels))
    assert {r.doc_id for r in kept.collect()} == {i for i in range(360) if i % 3} | {900, 901}
    assert toxicity.train(d, labels.limit(0)).scores(["idiot"])[0] < 0.01


@pytest.fixture(scope="module")
def toxic_model(spark):
    rng = np.random.default_rng(4)
    rows = [(i, "you a " + prose(rng, 25) + (" idiot moron stupid hate" if i % 3 == 0 else ""), int(i % 3 == 0)) for i in range(360)]
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.train(d.select("doc_id", "text"), d.select("doc_id", "toxic"))


def test_obfuscated_words_are_found(toxic_model):
    bad = ["hat3", "idi07", "the st0n3 hat3.", '"1d1ot"', "-1d1ot", "you,1d1ot", "(1d1ot!!)", "$tup1d", "1d-1ot", "i   d   i   o   t", "i\nd\ni\no\nt", "i,d,i,o,t", "i'd'i'o't", "1 d 1 0 t", "iddiot", "idiioott", "()\\/\\/ h47e".replace("h47e", "hat3"), "|-|ate", "st|_|pid", "m()r()n", "iiiiii" * 40 + "diot", "1" * 200 + "d1ot"]
    bad += ["a s t u p i d", "y o u s t u p i d", "t h e w a t e r  s t u p i d", " ".join("the river stone light water house silver stupid cloud paper".replace(" ", "")), "x" * 60 + ",1d1ot"]
    good = ["t h e r i v e r", "st0ne w4ter!", "a, b, c, d", "1 2 3 4 5", "x" * 5000, "a " * 5000, "ab1" * 5000]
    assert [t for t in bad if toxic_model.scores([t])[0] < 0.7] == []
    assert [t[:20] for t in good if toxic_model.scores([t])[0] >= 0.7] == []


def test_characters_of_all_documents_count(spark):
    texts = ["the river idiot"] * 12 + ["the river stone"] * 12 + ["Žluťoučký kůň, z9b ŽLUTÝ!", "上海 上海", None, ""] * 40
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    model = toxicity.train(d, spark.createDataFrame([(i, int(i < 12)) for i in range(24)], "doc_id long, toxic int"), 20)
    want = collections.Counter()
    for t in texts:
        for w in re.findall(r"[^\W\d_]+", (t or "").lower()):
            w = "^" + "".join(min(c, toxicity.ONE_CLASS) for c in w) + "$"
            want.update(w[i : i + 3] for i in range(len(w) - 2))
    assert model.chars.counts == dict(want)
    assert toxicity.restore("ž1utý", model.chars) == "žlutý"


def test_the_cheapest_restoration_is_brute_force():
    """Every reading of short tokens, priced by the definition, against Viterbi."""
    words = ["the", "tie", "hat", "that", "tail"]
    counts = collections.Counter(("^" + w + "$")[i : i + 3] for w in words * 3 for i in range(len(w)))
    model = toxicity.CharModel(dict(counts))
    priced = lambda w: sum(model.price(("^" + w)[max(0, i - 1) : i + 1], c) for i, c in enumerate(w + "$"))
    for token in ("th3", "7ie", "h4t", "t1e", "7h47", "ta1l", "hhat", "h@@t", "t0"):
        best = []
        def read(at, out, price):
            if at == len(token):
                best.append((price + priced(out), out))
                return
            ch = token[at]
            choices = [(c, toxicity.SWAP) for c in toxicity.LOOKALIKES.get(ch, "")] + [(ch, 0.0 if ch.isalpha() else toxicity.KEEP_SIGN)]
            for c, extra in choices:
                read(at + 1, out + c, price + extra)
                if out and c == out[-1]:
                    read(at + 1, out, price + extra + toxicity.SKIP_REPEAT)
        read(0, "", 0.0)
        said = toxicity.restore(token, model)
        assert abs(min(p for p, w in best if w == said) - min(best)[0]) < 1e-9


def test_layouts_give_one_model(spark):
    rng = np.random.default_rng(14)
    rows = [(i, prose(rng, 20) + (" idiot" if i % 4 == 0 else ""), "en" if i % 2 else "de", int(i % 4 == 0)) for i in range(240)]
    d = spark.createDataFrame([*rows, rows[0], (None, "idiot", "en", 1), (7000, None, None, None)], "doc_id long, text string, lang string, toxic int")
    models = []
    for parts in (1, 5):
        some = d.repartition(parts, "text")
        t = toxicity.train(some.select("doc_id", "text"), some.select("doc_id", "toxic"), 100)
        lang = langid.train(some, max_rows=60)
        models.append((t.words, t.weights.round(9).tolist(), lang.weights.round(9).tolist(), lang.temperature))
    assert models[0] == models[1] and b"idiot" in models[0][0]
    none = toxicity.train(d.select("doc_id", "text").limit(0), d.select("doc_id", "toxic"))
    assert toxicity.score(d, none).count() == 243 and toxicity.score_held_out(d.limit(0), d.select("doc_id", "toxic")).count() == 0


def replaced_by_hand(texts, mapping):
    """Entities in order, then the words of a text's names wherever they stand, with given surrogates."""
    titles = regex.compile(rf"^(?:{pii.TITLES}) ")

    def kind(e):
        return next(name for name, p in pii.PATTERNS if regex.fullmatch(p.replace(r"\k<s>", "(?P=s)").replace(r"\k<t>", "(?P=t)"), e))

    def one(e):
        k = kind(e)
        if k in ("card", "phone", "iban", "ssn"):
            new = iter(mapping[k, re.sub("[^0-9A-Za-z+]", "", e)])
            return "".join(next(new) if re.match("[0-9A-Za-z+]", c) else c for c in e)
        new = mapping[k, e.lower() if k in ("email", "ipv6") else e]
        return new.upper() if k in ("email", "ipv6") and e == e.upper() and e != e.lower() else new

    out = []
    for t in texts:
        found = list(regex.finditer(pii.ENTITY.replace(r"\k<s>", "(?P=s)").replace(r"\k<t>", "(?P=t)"), t or ""))
        words = {w.lower() for m in found if kind(m[0]) == "person" for w in regex.findall(pii.WORD, titles.sub("", m[0]))}
        swap = lambda m: (n.upper() if m[0] == m[0].upper() else n) if m[0].lower() in words and (n := mapping["word", m[0].lower()]) else m[0]  # noqa: B023, E731
        new, at = "", 0
        for m in found:
            new += regex.sub(pii.WORD, swap, t[at : m.start()]) + (regex.sub(pii.WORD, swap, m[0]) if kind(m[0]) == "person" else one(m[0]))
            at = m.end()
        out.append(None if t is None else new + regex.sub(pii.WORD, swap, t[at:]))
    return out


def test_names_agree_over_spellings(spark):
    texts = [
        "Mr. John Smith met Anna and John Smith. Mr. Smith left. Smith sat on SMITH's hat. Dr. J. O'Brien-Smith",
        "Dr. Anna Novak",
        "Ms. Anna Novak said: Anna",
        "Mr. Bob Stone",
        "Dr. Bob Stone; Bob",
        "josé.garcía@x.es a@b.co 2001:db8::1 fe80:0:0:0:0:0:0:1 12:34:56 AB:CD:EF:0:1:2:3:4",
        "3782 822463 10005 and 4619646426088949, 4619 6464 2608 8949",
        "DE89 3704 0044 0532 0130 00, 10.0.0.1 " + pii.MARK + " 123-45-6789 +1 (569) 555-4877",
        None,
        "",
        "Mary Poppins came. Poppins went. Plain 12 apples " * 3000,
        "Г-н Иван Петров и Петров; Κυρία Μαρία Παππά, Frau Müller-Lüdenscheidt",
    ]
    d = spark.createDataFrame([*enumerate(texts), (3, texts[3]), (None, texts[4])], "doc_id long, text string")
    d = d.withColumns({c: F.lit("clash") for c in ("row", "cut", "map", "found", "entity", "c0", "named")})
    rows = pii.replace(d).collect()
    assert pii.replace(d).columns == d.columns and len(rows) == len(texts) + 2 and all(r.map == r.c0 == "clash" for r in rows)
    got = {r.doc_id: r.text for r in rows}
    name = r"([\w'-]+)"
    m = re.match(rf"Mr\. {name} {name} met Anna and {name} {name}\. Mr\. {name} left\. {name} sat on {name}'s hat", got[0])
    assert m[1] == m[3] and m[2] == m[4] == m[5] == m[6] and m[7] == m[2].upper() and m[1] in pii.NAMES["latin", "m"]
    anna, bob = got[1].split()[1], got[3].split()[1]
    assert got[2].startswith("Ms. " + got[1][4:])
    assert got[2].endswith(anna) and anna[-1] in "a" and got[3][4:] == got[4][4 : len(got[3])] == got[None][4 : len(got[3])] and got[4].endswith(bob)
    assert bob in pii.NAMES["latin", "m"] and anna in pii.NAMES["latin", "f"]
    for leak in ("josé", "garcía", "db8", "fe80", "3782", "Smith", "Novak", "Stone", "Poppins", "Петров", "Παππά", "Müller", "123-45"):
        assert leak not in " ".join(t or "" for t in got.values())
    assert "12:34:56" in got[5] and got[8] is None and got[9] == "" and "Plain 12 apples" in got[10]
    luhn = lambda n: sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(n))) % 10
    cards = re.match(r"(\d{4}) (\d{6}) (\d{5}) and (\d{16}), ", got[6])
    assert luhn("".join(cards.groups()[:3])) == luhn(cards[4]) == 0 and got[6].replace(" ", "").endswith(cards[4] + "," + cards[4])
    iban = re.match(r"[0-9A-Z ]+", got[7])[0].replace(" ", "")
    assert iban[:2] == "DE" and int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    entities = [m[0] for t in texts for m in regex.finditer(pii.ENTITY.replace(r"\k<s>", "(?P=s)").replace(r"\k<t>", "(?P=t)"), t or "")]
    found = spark.createDataFrame([(e, 1) for e in entities], "entity string, times long")
    mapping = {(r.space, r.norm): r.surrogate for r in pii.surrogates(found).collect()}
    by_hand = replaced_by_hand(texts, mapping)
    assert [len(t or "") for t in by_hand] == [len(got[i] or "") for i in range(len(texts))]
    assert by_hand[5:11] == [got[i] for i in range(5, 11)]


def test_surrogates_stay_distinct(spark):
    names = [f"Mr. {a} {b}" for a in ("Ann", "Bob", "Cid", "Dan", "Eve") for b in (f"Q{chr(97 + i)}{chr(97 + j)}" for i in range(12) for j in range(12))]
    names += [f"a{i % 10}@x{i}.org" for i in range(300)] + [f"10.0.{i}.7" for i in range(200)]
    got = pii.surrogates(spark.createDataFrame([(n, 1) for n in names], "entity string, times long")).collect()
    of = {space: [r.surrogate for r in got if r.space == space] for space in ("word", "email", "ip")}
    assert {k: len(v) for k, v in of.items()} == {"word": 149, "email": 300, "ip": 200}
    assert all(len({x.lower() for x in v}) == len(v) for v in of.values())
    assert all(re.fullmatch(r"\d+(\.\d+){3}", x) for x in of["ip"]) and all(re.fullmatch(r"[a-z]\d@mail\d+\.example\.org", x) for x in of["email"])
    assert not {x.lower() for x in of["word"]} & {r.norm for r in got}


def test_a_form_with_too_few_values_is_an_error(spark, monkeypatch):
    monkeypatch.setattr(pii, "STUCK", 2)
    monkeypatch.setattr(pii, "_surrogate", lambda key, kind, norm, attempt: F.lit("same"))
    with pytest.raises(ValueError):
        pii.surrogates(spark.createDataFrame([("10.0.0.1", 1), ("10.0.0.2", 1)], "entity string, times long"))


def test_hilbert_neighbours_touch():
    cells = np.array([(x, y) for x in range(16) for y in range(16)])
    order = cells[np.argsort(neighbours.hilbert_key(cells, 4))]
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_nearest(spark):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 24))
    x = centres[rng.integers(0, 8, 900)] + 0.3 * rng.normal(size=(900, 24))
    x[100:140] = x[100]  # equal vectors
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2020, [0.0] * 24), (2040, [float("nan")] * 24), (2060, [1.0, None] + [0.0] * 22), (2080, [])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit(1))
    got = collections.defaultdict(list)
    for r in neighbours.nearest(d, 20, 20, 128, 6).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(range(0, 900, 20))
    hit = 0
    for q, mine in got.items():
        s = x @ x[q]
        s[q] = -np.inf
        best = np.lexsort((np.arange(900), -s))[:20]
        assert len(mine) == 20 and all(abs(score - x[v] @ x[q]) < 1e-12 for v, score in mine)
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        hit += len({v for v, _ in mine} & set(best.tolist()))
    assert hit / (20 * len(got)) >= 0.9
    assert [v for v, _ in got[120]][:3] == [100, 101, 102] if abs(x[100] @ x[100] - max(x @ x[100])) < 1e-9 else True
    assert neighbours.nearest(d.limit(0)).count() == 0
    few = neighbours.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5])], "vec_id long, embedding array<float>"))
    assert [tuple(r) for r in few.collect()] == [(0, 1, 1, 0.5)]


def test_ties_are_whole(spark):
    """Quantised vectors: hundreds of equal inner products, of which the smaller ids win."""
    rng = np.random.default_rng(3)
    x = rng.integers(0, 2, (700, 8)) * 2.0 - 1.0
    x = np.hstack([x, np.eye(700)[:, :24] * 0])  # no entry for itself: vectors repeat as well
    x[np.arange(700), 8 + np.arange(700) % 24] = 0.25 * (1 + np.arange(700) % 3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(5000, [1.0, 2.0]), (5020, [2.0, 1.0])]
    got = collections.defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), 20, 20).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    for q in range(0, 700, 20):
        s = neighbours.inner(x[q], x)
        s[q] = -np.inf
        best = np.lexsort((np.arange(700), -s))[:20]
        assert sorted(got[q]) == [(i + 1, int(v), float(s[v])) for i, v in enumerate(best)]
    assert got[5000] == [(1, 5020, 4.0)] and got[5020] == [(1, 5000, 4.0)]


def test_reach_grows_until_recall(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 24))
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in neighbours.nearest(d, 20, 20, 32, 3).collect():
        got[r.query_id].add(r.vec_id)
    hit = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(got[q] & set(np.argsort(-s)[:20].tolist()))
    assert hit / (20 * 150) >= 0.9
    assert neighbours.reach_of([([0.0], [9.0]), ([0.0], [5.0])], [np.arange(1.0, 10.0)]) == 9


def test_language_training_holds_no_object_a_number(spark):
    rng = np.random.default_rng(5)
    letters = np.array([chr(c) for c in range(0x100, 0x800) if chr(c).isalpha()])
    texts = ["".join(rng.choice(letters, 1200)) for _ in range(300)]
    numbers = sum(np.count_nonzero(langid.ngram_counts(t)) for t in texts)
    docs = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    tracemalloc.start()
    try:
        langid.train(docs)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32 * numbers


def test_toxicity_training_collects_no_tables_as_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    texts = [prose(rng, 25) + (" moron" if i % 3 == 0 else "") for i in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    sizes, collect = [], type(docs).collect

    def counted(df):
        rows = collect(df)
        sizes.append(len(rows))
        return rows

    monkeypatch.setattr(type(docs), "collect", counted)
    model = toxicity.train(docs, labels)
    assert b"moron" in model.words and model.chars.counts and max(sizes) <= 2  # rows of either label
