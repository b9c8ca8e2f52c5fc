"""Operators against brute force, exact round trips and odd inputs."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from ledgerline.llm import bpe, chat, langid, licenses, neardup, packing, pages, topk, toxicity, winnow
from ledgerline.llm.common import ship_code, space_units

ODD = [(1, None, "en"), (2, "", None), (3, " \n ", "en"), (None, "a null id", "de"), (4, "x" * 20_000, "en"),
       (5, "one two", "en"), (5, "one two", "en"), (6, "  two  spaces \n\n kept ", ""), (7, "日本語 テスト 😀 1½", "ja"),
       (8, "it's <|endoftext|> I'll", "en"), (9, "... !!! 12", "en"), (10, "word " * 3000, "en")]


@pytest.fixture(autouse=True)
def shipped(spark):
    ship_code(spark)


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text, lang) with a column whose name clashes with results."""
    def make(rows):
        return spark.createDataFrame([(i, t, lang, "src", "x") for i, t, lang in rows],
                                     "doc_id long, text string, lang string, source string, score string")
    return make


def tokenizer():
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


# 1 -------------------------------------------------------------------------------------------------
def brute_top(rows, k):
    v = {i: np.floor(64 * np.array(x, float)).astype(int) for i, x in rows
         if i is not None and x and all(y is not None and np.isfinite(y) for y in x)}
    out = set()
    for q in (i for i in v if i % 20 == 0):
        best = sorted(((-int(v[q] @ v[c]), c) for c in v if c != q))[:k]
        out |= {(q, r + 1, c, -s) for r, (s, c) in enumerate(best)}
    return out


def test_topk_matches_brute_force_with_ties_nulls_and_many_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=8) * rng.choice([0.1, 1, 3]), 1)]) for i in range(700)]
    rows += [(1000 + i, [1.0] * 8) for i in range(60)]                       # ties
    rows += [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame([(i, x, "e") for i, x in rows], "vec_id long, embedding array<float>, score string")
    got = topk.top_k(df, F.col("id") % 20 == 0, k=5, block_rows=64, queries_per_task=16).collect()
    assert {tuple(r) for r in got} == brute_top([(i, [None if y is None else np.float32(y) for y in x] if x else x)
                                                 for i, x in rows], 5)


def test_topk_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("id") % 20 == 0).count() == 0


# 2 -------------------------------------------------------------------------------------------------
def brute_selection(text):
    """Window minima of the hashes of all runs of characters, rightmost on ties, with the query's own numbers."""
    import xxhash
    signed = lambda x: x - (1 << 64) if x >> 63 else x

    c = [ch for ch in text if ch not in " \t\n\x0b\f\r"]
    runs = ["".join(c[i:i + 16]) for i in range(max(1, len(c) - 15))] if c else []
    grams = [signed(xxhash.xxh64_intdigest(r.encode(), seed=42)) >> 31 for r in runs]
    if not grams:
        return []
    w, out = min(16, len(grams)), []
    for i in range(len(grams) - w + 1):
        low = min(grams[i:i + w])
        p = max(j for j in range(i, i + w) if grams[j] == low)
        if (low, p) not in out:
            out.append((low, p))
    return out


def winnow_texts():
    random.seed(5)
    pick = lambda letters, n: "".join(random.choice(letters) for _ in range(n))
    texts = ["", "ab", " \n ", "one two three", "aaaa " * 30, "x" * 15, "x" * 16, "y" * 31, "日本語テスト😀" * 9]
    texts += [pick("ab ", n) for n in (20, 40, 61, 62, 63, 77, 92, 93, 124, 200)]
    return texts + [pick("abcdefgh é😀", random.randrange(1, 400)) for _ in range(30)]


@pytest.mark.parametrize("pieces", [(), (32,), (100, 7), winnow.PIECES])
def test_winnowing_selects_rightmost_window_minima(documents, pieces):
    df = documents([(i, t, "en") for i, t in enumerate(winnow_texts())])
    sel = winnow.selection(winnow.without_space(F.col("text")), pieces)
    for r in df.withColumn("sel", sel).select("text", winnow.entries("sel").alias("e")).collect():
        assert [(x["hash"], x["position"]) for x in r["e"]] == brute_selection(r["text"])


def test_winnowing_of_edited_texts_equals_their_own_selection(spark):
    """Every pair of texts, cut at every kind of place: around both thresholds and in space."""
    texts = winnow_texts()
    random.seed(6)
    rows = []
    for k in range(900):
        a, b = random.choice(texts), random.choice(texts)
        i, j = (random.choice([0, 1, len(x), len(x) // 2, random.randrange(len(x) + 1)]) for x in (a, b))
        rows.append((k, a, a[:i], b, b[:j], a[:i] + b[:j]))
    bare = lambda c: winnow.without_space(F.col(c))
    df = spark.createDataFrame(rows, "k int, a string, head string, b string, tail string, whole string").repartition(8)
    df = df.select("k", "whole", winnow.seam_selection(winnow.selection(bare("a")), bare("head"), winnow.selection(bare("b")), bare("tail")).alias("got"),
                   winnow.selection(bare("whole")).alias("want"))
    assert df.where("got <> want").count() == 0
    some = df.where("k % 30 = 0").select("whole", winnow.entries("got").alias("e")).collect()
    assert all([(x["hash"], x["position"]) for x in r["e"]] == brute_selection(r["whole"]) for r in some)


def test_winnowing_fingerprints_match_brute_force(documents):
    texts = winnow_texts()
    rows = sorted(((i, t) for i, t in enumerate(texts)), reverse=True)
    got = {r["doc_id"]: r for r in winnow.fingerprints(documents([(i, t, "en") for i, t in rows]), docs_per_bucket=7).collect()}
    alike = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        half = len(t) // 2
        own, new, nxt = ({h for h, _ in brute_selection(x)} for x in (t, t[:len(t) - half] + after[:half], after))
        assert got[i]["near_edited"] == pytest.approx(alike(own, new)) and got[i]["near_next"] == pytest.approx(alike(own, nxt))


def test_winnowing_edits_with_the_next_document(documents):
    rows = [(i, t) for i, t, _ in ODD if i is not None and i != 5] + [(40, "a lone far id " * 9)]
    got = {r["doc_id"]: r for r in winnow.fingerprints(documents([(i, t, "en") for i, t in rows]), docs_per_bucket=2).collect()}
    order = sorted(((i, t or "") for i, t in rows), reverse=True)
    for k, (i, t) in enumerate(order):
        after, half = order[(k + 1) % len(order)][1], len(t) // 2
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256((t[:len(t) - half] + after[:half]).encode()).hexdigest()
        assert 0 <= got[i]["near_edited"] <= 1 and 0 <= got[i]["near_next"] <= 1
    plan = winnow.fingerprints(documents([(1, "a b", "en")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_winnowing_keeps_repeated_and_null_ids(documents):
    got = winnow.fingerprints(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert len({r["fingerprint"] for r in got if r["doc_id"] == 5}) == 1
    assert winnow.fingerprints(documents([])).count() == 0


def test_winnowing_finds_a_passage_of_unspaced_text_at_any_offset(documents):
    random.seed(11)
    run = "".join(random.choice("日本語テスト東京都😀") for _ in range(600))
    rows = [(10, "x" + run, "ja"), (9, run, "ja"), (8, "yz" + run[100:500] + "w" * 3, "ja"), (7, "\n" + run[:300] + " \t" + run[300:], "ja")]
    got = {r["doc_id"]: r for r in winnow.fingerprints(documents(rows)).collect()}
    assert got[10]["near_next"] > 0.9 and got[9]["near_next"] > 0.5 and got[8]["near_next"] > 0.5
    assert got[7]["fingerprint"] == got[9]["fingerprint"]        # white space is left out


# 3 -------------------------------------------------------------------------------------------------
def test_cuts_are_optimal():
    rng = random.Random(2)
    for _ in range(40):
        pos = np.cumsum([rng.randrange(1, 6) for _ in range(rng.randrange(1, 12))])
        kind = np.array([rng.randrange(3) for _ in pos])
        pen = (0, 2, 5)

        def cost(cuts):
            begins = [0] + [pos[c] for c in cuts[:-1]]
            return sum(10 - (pos[c] - b) + pen[kind[c]] for c, b in zip(cuts, begins))

        best = min(cost(c) for m in range(1 << (len(pos) - 1))
                   for c in [[i for i in range(len(pos) - 1) if m >> i & 1] + [len(pos) - 1]]
                   if all(pos[x] - (pos[y] if y is not None else 0) <= 10 for x, y in zip(c, [None, *c[:-1]])))
        assert cost(packing.choose_cuts(pos, kind, 10, pen)) == best


def test_packing_places_every_token_once(documents):
    tok = tokenizer()
    rows = ODD + [(20 + i, "A sentence here. Another one! " * (i * 7), "en") for i in range(30)]
    got = packing.pack_documents(documents(rows), public_tokenizers.path("byte_bpe_50k.json"), window=64, long_gap=16,
                                 docs_per_bucket=8, segment_tokens=400).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    for i, t, _ in rows:
        if i == 5:
            continue
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            piece = np.array(ids[at:at + r["length"]], "<u4").tobytes()
            assert (r["start"], r["doc_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(piece))
            at += r["length"]
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at <= 64
    assert packing.pack_documents(documents([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


# 4 -------------------------------------------------------------------------------------------------
def test_bpe_equals_the_library_and_round_trips(documents):
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    random.seed(1)
    rows = ODD + [(100 + i, "".join(random.choice("ab \n'tés1.日") for _ in range(200)), "en") for i in range(40)]
    got = bpe.encode_decode(documents(rows), path, public_tokenizers.PATTERN).collect()
    want = sorted((str(i), np.array(lib.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t, _ in rows)
    assert sorted((str(r["doc_id"]), bytes(r["ids"]), bytes(r["decoded"])) for r in got) == want
    assert bpe.encode_decode(documents([]), path, public_tokenizers.PATTERN).count() == 0


def test_units_join_to_their_text():
    texts = [t or "" for _, t, _ in ODD]
    codes, values = space_units(pa.array(texts))
    assert ["".join(values[c] for c in row) for row in codes] == texts


# 5 -------------------------------------------------------------------------------------------------
def brute_components(rows):
    def shingles(t):
        w = [x for x in regex.split(rb"[\x20\x09-\x0D]+", regex.sub(rb"[A-Z]", lambda m: m[0].lower(), (t or "").encode())) if x]
        return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])
    sets = {i: shingles(t) for i, t, _ in rows}
    comp = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and sets[b]:
                x, y = comp[a], comp[b]
                comp = {i: min(x, y) if c in (x, y) else c for i, c in comp.items()}
    return {(i, len(sets[i]), comp[i], comp[i] == i) for i in sets}


def test_near_duplicates_match_brute_force(documents):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for g in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(3, 90))]
        for _ in range(rng.randrange(1, 14)):
            words = list(base)
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            rows.append((len(rows) + 1, " ".join(words), "en"))
    rows += [(500, "Same Words here", "en"), (501, "same words HERE", "en"), (502, "\x0b\t", "en"), (503, None, "en"),
             (504, "a\u00a0b c", "en"), (505, "a b c", "en")]
    rng.shuffle(rows)
    got = neardup.near_duplicates(documents(rows)).collect()
    assert {tuple(r) for r in got} == brute_components(rows)


def test_near_duplicates_of_odd_rows(documents):
    got = neardup.near_duplicates(documents(ODD)).collect()
    assert len(got) == len(ODD)
    assert {(r["component_id"], r["kept"]) for r in got if r["doc_id"] == 5} == {(5, True)}
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, True)]
    assert neardup.near_duplicates(documents([])).count() == 0


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = dict(map(tuple, neardup.components(edges).collect()))
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


# 6 -------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("text", ["", "<|im_end|>", "<\\|im_start|>", "<\\\\|x", "<", "a<|b<\\|c<|", "\\n\n"])
def test_escape_is_undone(text):
    assert "<|" not in chat.escape(text) and chat.unescape(chat.escape(text)) == text
    assert "\n" not in chat.escape_role(text) and chat.unescape_role(chat.escape_role(text)) == text


def test_parts_become_numbered_placeholders(spark):
    part = lambda kind, text=None, ref=None, units=None: {"type": kind, "text": text, "ref": ref, "units": units}
    turns = spark.createDataFrame(
        [(1, 0, "user", [part("text", "see <|image 9|>"), part("image", None, "a.png", 2), part("audio", None, "b.wav", 3)]),
         (1, 1, "assistant", [part("text", "two words"), part("document", "its text", "c.pdf")]),
         (2, None, None, None)], f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = sorted(chat.format_turns(turns).collect(), key=lambda r: (r["conv_id"], r["n"]))
    assert rows[0]["piece"] == "<|im_start|>user\nsee <\\|image 9|><|image 1|><|audio 2|><|im_end|>\n"
    assert [(a["number"], a["ref"], a["tokens"]) for a in rows[0]["attachments"]] == [(1, "a.png", 512), (2, "b.wav", 75)]
    assert rows[1]["attachments"][0]["number"] == 3 and rows[1]["tokens"] == 2 + 512 + 2
    assert chat.parse(rows[0]["piece"]) == [("user", [("text", "see <|image 9|>"), ("image", 1), ("audio", 2)])]
    assert chat.parse(rows[2]["piece"]) == [("", [("text", "")])]


# 7 -------------------------------------------------------------------------------------------------
PAGE = ("<html><head><title>T</title><style>x</style><script>var a='</p>';</script></head><body><nav>menu</nav>"
        "<div class=ad>buy</div><article><h1>Head &amp; more</h1><p>One<br>two &lt;3<p>three\n  four</article>"
        "<div id=comments><p>first!</div><footer>&copy; x</footer>")


def test_pages_keep_the_article_and_delete_shared_lines(spark):
    plain = "<body><p>Site name</p><p>{}</p><p>All about us</p>"
    df = spark.createDataFrame(
        [(1, "http://a.org/x/1", PAGE), (2, "http://a.org/x/2", PAGE), (3, None, None), (4, "http://b.org/1", plain.format("own one")),
         (5, "http://b.org/2", plain.format("own two")), (6, "http://c.org/", plain.format("alone"))],
        "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract(df.coalesce(1)).collect()}
    article = "Head & more\n\nOne two <3\n\nthree four"
    assert got == {1: article, 2: article, 3: "", 4: "own one", 5: "own two", 6: "Site name\n\nalone\n\nAll about us"}
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_keep_unshared_text_beside_an_article(spark):
    body = "<body><p>Site name</p><article>Teaser {0}</article><div>Body {0}</div><div>All about us</div>"
    df = spark.createDataFrame([(i, f"http://a.org/{i}", body.format(i)) for i in range(3)],
                               "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert got == {i: f"Teaser {i}\n\nBody {i}" for i in range(3)}


def test_pages_find_their_neighbour_across_ranges(spark):
    plain = "<body><p>Site name</p><p>own {}</p><p>All about us</p>"
    df = spark.createDataFrame([(i, f"http://{'ab'[i // 6]}.org/{i:02}", plain.format(i)) for i in range(12)],
                               "page_id long, url string, html string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted((r["page_id"], r["text"], r["shared_lines"]) for r in pages.extract(df).collect())
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got == [(i, f"own {i}", 2) for i in range(12)]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(6)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(9))] for _ in "ab")
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert len(pages.shared_lines(a, b)) == table[-1][-1]


# 8, 9 ----------------------------------------------------------------------------------------------
def test_toxicity_learns_from_labels_outside_the_fold(spark, documents):
    rng = random.Random(7)
    clean = ["the", "river", "runs", "by", "house", "green", "tree", "small", "road", "walk"]
    rows, labels = [], []
    for i in range(400):
        words = [rng.choice(clean) for _ in range(rng.randrange(4, 60))]
        bad = i % 3 == 0
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["stupid", "idiot", "moron"])
        rows.append((i, " ".join(words), "en"))
        labels.append((i, int(bad)))
    docs = documents(rows + [(900, "you stupidd", "en"), (901, None, "en"), (902, "", "en"), (None, "tree", "en")])
    model = toxicity.train(docs, spark.createDataFrame(labels + [(3, None), (None, 1)], "doc_id long, toxic int"))
    got = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    assert sum(got[i]["predicted"] == t for i, t in labels) >= 395
    assert got[900]["predicted"] == 1 and got[901]["predicted"] == got[902]["predicted"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score(documents([]), toxicity.train(docs, none)).count() == 0


def test_language_by_family_then_pairs(documents):
    rng = random.Random(8)
    words = {"en": "the and thing with which", "de": "und der nicht schön über", "fr": "être les était où ça",
             "es": "año niño los está qué"}
    rows = [(i, " ".join(rng.choice(words[x].split()) for _ in range(rng.randrange(1, 30))), x)
            for i, x in enumerate(rng.choice(sorted(words)) for _ in range(300))]
    docs = documents(rows + [(900, None, "en"), (901, "12 !", "fr"), (902, "", None), (None, "und", "de")])
    got = {r["doc_id"]: r for r in langid.predict(docs, langid.train(docs)).collect()}
    assert sum(got[i]["lang_pred"] == x for i, _, x in rows) >= 295
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    assert all(0 <= r["score"] <= 1 for r in got.values())
    empty = documents([])
    assert langid.train(empty) == b"" and langid.predict(docs, b"").where("lang_pred = 'und'").count() == len(rows) + 4


@pytest.mark.parametrize("lang, told", [("en", "en"), (None, "und")])
def test_language_of_one_language_or_of_none(spark, documents, scratch, lang, told):
    import corpus_pipeline
    from ledgerline.llm.queries import op9_language
    sf = scratch("one-language")
    rows = [(i, f"the river runs {i}", lang) for i in range(40)]
    documents(rows + [(900, None, lang), (901, "12 !", lang), (902, "", lang)]).write.parquet(f"{sf}/documents.parquet")
    got = {r["doc_id"]: r for r in op9_language(spark, sf).collect()}
    assert len(got) == 43 and {got[i]["lang_pred"] for i, _, _ in rows} == {told}
    assert [got[i]["lang_pred"] for i in (900, 901, 902)] == ["und"] * 3
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = corpus_pipeline.drop_unknown_language(spark, docs, sf)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == list(range(40))


# 10 ------------------------------------------------------------------------------------------------
def brute_base(text):
    w = regex.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", regex.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at = [(i, label) for phrase, label in licenses.BASE.items() for p in [phrase.split()]
          for i in range(len(w)) if w[i:i + len(p)] == p]
    return (len(w), len(at), min((i for i, _ in at), default=None), max((i for i, _ in at), default=None),
            ",".join(sorted({x for _, x in at})))


def test_license_base_phrases_match_brute_force(documents):
    rng = random.Random(9)
    bits = ["cc", "by", "CC-BY", "general", "public", "license", "all", "rights", "reserved", "x", "é", ".", "\n"]
    rows = ODD + [(200 + i, " ".join(rng.choice(bits) for _ in range(60)), "en") for i in range(60)]
    got = licenses.scan_licenses(documents(rows)).collect()
    base = sorted((str(r["doc_id"]), str((r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]))) for r in got)
    assert base == sorted((str(i), str(brute_base(t))) for i, t, _ in rows)
    assert licenses.scan_licenses(documents([])).count() == 0


def test_license_expressions():
    assert licenses.to_postfix("a or b and c with d".split()) == "a b c d with and or".split()
    assert licenses.evaluate("MIT OR GPL-3.0-only") == ({"mit", "gpl"}, 0.1)
    assert licenses.evaluate("(MIT OR GPL-2.0) AND CC-BY-NC-4.0")[1] == 0.9
    assert licenses.evaluate("GPL-2.0 WITH Classpath-exception-2.0")[1] == pytest.approx(0.56)
    assert licenses.evaluate("(MIT AND") == ({"mit"}, 0.1)
    got = licenses.scan("# SPDX-License-Identifier: MIT OR Apache-2.0\n")
    assert got[5] == "apache,mit" and got[6] == 0.1 and got[1] == 0


# pipeline ------------------------------------------------------------------------------------------
def test_pipeline_stages_equal_their_operators(spark, tmp_path):
    import corpus_pipeline
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    clean = corpus_pipeline.drop_toxic(spark, docs, sf)
    bad = {r["doc_id"] for r in toxicity.score(docs, toxicity.train(docs, labels)).where("predicted = 1").collect()}
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in docs.collect()} - bad
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf)
    want = {c for _, _, c, _ in brute_components([(r["doc_id"], r["text"], None) for r in docs.collect()])}
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
    packed = corpus_pipeline.run(spark, sf)
    assert packed.where("length <= 0").count() == 0 and {r["doc_id"] for r in packed.collect()} <= want


def pipeline_tables(spark, folder, rows, labels):
    df = spark.createDataFrame([(i, t, lang, "src", 1) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return df


def test_pipeline_of_odd_tables(spark, scratch):
    import corpus_pipeline
    prose = lambda k: f"the quiet river number {k} runs past mill {k} and under bridge {k} towards the sea again"
    rows = [(i, prose(i), "en") for i in range(20)]
    rows += [(None, prose(50), "en"), (None, "", "en"), (3, prose(3), "en"), (4, "quite another text under a taken id with words enough to stand alone", "en"),
             (70, None, "en"), (71, "  ", "en"), (72, "12 34", "en"), (73, prose(19), "en")]
    sf = scratch("odd-pipeline")
    docs = pipeline_tables(spark, sf, rows, [])                             # no labels at all
    assert corpus_pipeline.drop_toxic(spark, docs, sf).count() == len(rows)
    lettered = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    assert corpus_pipeline.drop_unknown_language(spark, docs, sf).count() == len(lettered)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, sf).collect()
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept) == sorted(
        (str(i), t or "") for i, t, _ in dict.fromkeys(rows) if i != 73)     # both texts of id 4, one of each repeated row
    packed = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in packed} == {None, *range(20)} and sum(r["doc_id"] == 4 for r in packed) == 2
    empty = scratch("empty-pipeline")
    pipeline_tables(spark, empty, [], [])
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_language_stage_rejects_what_was_never_learned_or_is_not_wanted(spark, scratch):
    import corpus_pipeline
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = langid.train(docs)
    foreign = spark.createDataFrame([(-1, "これは日本語の文章です。東京都に住んでいます。" * 5), (-2, "Это русский текст, написанный для проверки. " * 5),
                                     (-3, "한국어로 쓴 글입니다. " * 9)], "doc_id long, text string")
    assert langid.accepted(foreign, model).count() == 0
    extra = docs.unionByName(foreign, allowMissingColumns=True)
    kept = corpus_pipeline.drop_unknown_language(spark, extra, sf)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in docs.select("doc_id").collect()}     # clean ones all stay, foreign ones go
    few = langid.accepted(docs, model, ("de", "fr")).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in few if r["count"] > 3}.keys() == {"de", "fr"}
    sure = langid.accepted(docs, model, least=0.9)
    assert 0 < sure.count() < docs.count() and sure.columns == docs.columns


def test_language_margins_equal_plain_loops(spark):
    """Margins and votes of the trained arrays, word by word and gram by gram."""
    import io
    from ledgerline.llm.common import subwords
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs)
    held = np.load(io.BytesIO(model))
    weights, names, machines = held["weights"], held["names"].tolist(), held["machines"].tolist()
    bits = int(weights.shape[0]).bit_length() - 1
    some = docs.where("doc_id % 9 = 0 AND text IS NOT NULL")
    told = {r["doc_id"]: r for r in langid.predict(some.drop("lang"), model).collect()}
    for r in some.collect():
        if not regex.search(r"\p{L}", r["text"]):
            continue
        margins = []
        words = r["text"].lower().split()
        for k in range(len(machines)):
            total = 0.0
            for w in words:
                grams, _ = subwords([w], langid.SIZES, bits)
                total += float(np.mean([weights[g, k] for g in grams])) if len(grams) else 0.0
            margins.append(total / len(words) + float(held["biases"][k]))
        margin = dict(zip(machines, margins))
        kinds = sorted({langid.family_of(x) for x in names})
        kind = max(kinds, key=lambda f: margin[f"family {f}"]) if len(kinds) > 1 else kinds[0]
        members = [x for x in names if langid.family_of(x) == kind]
        votes, sums = dict.fromkeys(members, 0), dict.fromkeys(members, 0.0)
        for i, a in enumerate(members):
            for b in members[i + 1:]:
                m = margin[f"pair {a} {b}"]
                votes[a if m >= 0 else b] += 1
                sums[a] += m
                sums[b] -= m
        best = max(members, key=lambda x: votes[x] + 0.4 * np.tanh(sums[x]) / len(members))
        assert told[r["doc_id"]]["lang_pred"] == best, r["text"][:80]


def test_oracles_match(spark):
    import duckdb

    from ledgerline.llm.queries import ORACLES, QUERIES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("embeddings", "conversations", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{sf}/{t}.parquet'")
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        res = con.execute(sql)
        assert df.columns == [d[0] for d in res.description]
        assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, res.fetchall()))


def test_ranked_encoding_gives_the_ids_of_the_tokenizer(spark):
    from tokenizers import Tokenizer
    t = tokenizer()
    ranked = packing.ranked_encoding(t)
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() if r["text"]]
    texts += [x for _, x, _ in ODD if x] + ["a　b  c", "̀x", "1²½", "\x00\x7f", "it's we'll I'M", "\r\n\r\n  x \t", "🏳️‍🌈🇩🇪"]
    for text in texts:
        assert ranked.encode_ordinary(text) == t.encode(text, add_special_tokens=False).ids
    assert packing.ranked_encoding(Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))) is None


def test_packing_encodes_whole_texts_as_the_tokenizer_does(spark):
    t = tokenizer()
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r["text"] or "" for r in rows] + [x or "" for _, x, _ in ODD] + [
        "a, b.", "x.. y!? z", "¾. ²! é,", "end ", " lead", "  two", "word.\nnext, line", "(a). 'b'; c:", "a . b", "日本. 語,", "ń. m"]
    for packer in (packing.Packer(public_tokenizers.path("byte_bpe_50k.json"), 2048, 1, (0, 16, 48), 96) for _ in range(2)):
        got = packer.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]
        packer.ranked = None                                    # by the tokenizer itself
        packer.words._clear()
        got = packer.encode(pa.array(texts, pa.string()))
        assert [x.tolist() for x in got] == [t.encode(x, add_special_tokens=False).ids + [1] for x in texts]
    assert packer.encode(pa.array([], pa.string())) == []


def test_order_buckets_stay_small_with_one_far_id_and_many_null_ids(spark):
    from ledgerline.llm.common import order_buckets
    n, per = 20_000, 100
    ids = spark.range(n).select(F.when(F.col("id") % 3 == 0, None).when(F.col("id") == 1, 10 ** 15).otherwise(F.col("id")).alias("doc_id"),
                                F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    rows = ids.withColumn("bucket", order_buckets(ids, per)).withColumn("tie", F.xxhash64("text"))
    sizes = [r["count"] for r in rows.groupBy("bucket").count().collect()]
    assert max(sizes) <= 4 * per and len(sizes) > n / per / 4
    ends = rows.where("doc_id IS NOT NULL").groupBy("bucket").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).orderBy("bucket").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:])) and ends[0]["bucket"] >= 0
    ends = rows.where("doc_id IS NULL").groupBy("bucket").agg(F.min("tie").alias("lo"), F.max("tie").alias("hi")).orderBy("bucket").collect()
    assert all(a["hi"] < b["lo"] for a, b in zip(ends, ends[1:])) and ends[-1]["bucket"] == -1


def test_winnowing_of_a_very_long_text(documents):
    """Pieces of pieces: the same selection as by small ones, far from the start too."""
    random.seed(9)
    rows = [(1, "".join(random.choice("abcdefgh ") for _ in range(400_000)), "en"), (2, "z" * 300_000, "en")]
    df = documents(rows).withColumn("chars", winnow.without_space(F.col("text")))
    got = df.select("doc_id", winnow.selection(F.col("chars")).alias("a"), winnow.selection(F.col("chars"), (1 << 14,)).alias("b"),
                    F.length("chars").alias("n"))
    r = {x["doc_id"]: x for x in got.select("doc_id", "n", (F.col("a") == F.col("b")).alias("same"), F.size("a").alias("k")).collect()}
    assert all(x["same"] for x in r.values())
    assert 2 * r[1]["n"] / 17 * 0.9 < r[1]["k"] < 2 * r[1]["n"] / 17 * 1.1
    assert r[2]["k"] == 300_000 - 30                    # equal hashes: the rightmost of every window


def test_stray_and_open_tags_cost_no_search():
    import time
    began = time.process_time()
    broken = "<div>" * 50_000 + "text" + "</section>" * 50_000 + "</nav></p></article>" * 1000
    assert pages.page_lines(broken) == [("text", pages.OTHER)]
    assert time.process_time() - began < 5


def test_the_head_of_an_article_is_text_if_it_holds_a_heading():
    kept = lambda html: pages.main_text(pages.page_lines(html), [])[0].split("\n\n")
    assert kept("<header><h1>Site</h1></header><article><header><h1>Title</h1><p>By A</p></header><p>Body</p></article>") == ["Title", "By A", "Body"]
    assert kept("<article><header><p>menu words</p></header><p>Body</p><header><h2>More</h2></header></article>") == ["Body", "More"]
    assert kept("<article><header class='banner'><h1>Ad</h1></header><p>Body</p></article>") == ["Body"]
    assert kept("<article><header><h1>Never closed<p>Body</article>") == ["Never closed", "Body"]
    assert kept("<main><header>x<header><h2>T</h2></header>y</header>z</main>") == ["x", "T", "y", "z"]


def test_alignment_decides_before_the_place_in_the_page():
    page = [("menu", pages.FURNITURE), ("shared", pages.OTHER), ("own", pages.OTHER), ("copied", pages.ARTICLE), ("ad 7", pages.FURNITURE)]
    assert pages.main_text(page, [hash(x) for x in ("menu", "shared", "copied")]) == ("own\n\ncopied", 3, 1)
