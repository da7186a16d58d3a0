"""The operators of the training-data package on small frames: brute force, exact round trips, held-out accuracy, and the edges (nulls, empty, repeats, clashing columns)."""

import hashlib
import random
import re
import zlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from quadrille.llm import bpe, decontamination, exact_dedup, html_text, lexicon, licenses, near_dedup, sharding, token_counts, toxicity, url_filter
from quadrille.llm.components import components

WORD_BPE, BYTE_BPE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

EDGES = [(1, "Same text, here."), (2, "same TEXT, here."), (3, None), (4, ""), (5, "É same"), (6, "é same"), (None, "same text, here."), (7, "x " * 30_000), (8, "<|endoftext|>a  b\n\n c<|startoftext|>"), (2, "same TEXT, here.")]


def frame(spark, rows, *more):
    """Documents with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, "x", 7, "y", 0) for r in rows], "doc_id long, text string, digest string, row int, keep_id string, node int").repartition(3)


def none(spark):
    return spark.createDataFrame([], "doc_id long, text string")


# --- BPE and token counts -------------------------------------------------------------------------------------------


def odd_texts(n=300):
    rnd = random.Random(3)
    alphabet = [*"abcABC XYZ 0129'sreltm.,!?\n\t\x1c\x85\xa0 éÅΣσİßǅﬁ中あ🙂½Ⅷ٣‍\x00<|>", "<|endoftext|>", "<|startoftext|>", " the ", "'ll", "é", "  "]
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(n)] + ["ab" * 400, "q" * 3000]


def test_bpe_equals_the_library(spark):
    texts = odd_texts()
    lib = Tokenizer.from_file(WORD_BPE)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoded = bpe.encode(docs, WORD_BPE, outputs=("n_tokens", "ids", "decoded", "decoded_sha256"))
    for r in bpe.decode(encoded, WORD_BPE, out_col="again").collect():
        expected = lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == expected and r["n_tokens"] == len(expected)
        assert r["decoded"] == r["again"] == lib.decode(expected, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()


def test_bpe_edges(spark):
    found = {(r["doc_id"], r["n_tokens"]) for r in bpe.encode(frame(spark, EDGES), WORD_BPE).collect()}
    assert (3, 0) in found and (4, 0) in found and (7, 30_000) in found
    assert bpe.encode(none(spark), WORD_BPE).count() == 0
    more = bpe.encode(frame(spark, EDGES), WORD_BPE, frequent_words=["same", "unheardofword"]).select("doc_id", F.col("ids").cast("string"))
    assert sorted(map(str, more.collect())) == sorted(map(str, bpe.encode(frame(spark, EDGES), WORD_BPE).select("doc_id", F.col("ids").cast("string")).collect()))


def test_lexicon_is_minimal_and_complete(tmp_path):
    words = {w.encode(): (k, k + 1) for k, w in enumerate(["tap", "taps", "top", "tops", "stop", "stops", ""])}
    lexicon.save(str(tmp_path / "x"), lexicon.compile_words(words))
    t = lexicon.load(str(tmp_path / "x"))
    asked = [*words, b"to", b"tapss", b"z", "é".encode()]
    ranks = lexicon.ranks(t, asked)
    assert ranks.tolist() == [sorted(words).index(w) if w in words else -1 for w in asked]
    assert [tuple(t["ids"][t["offsets"][r] : t["offsets"][r + 1]]) for r in ranks[: len(words)]] == list(words.values())
    assert len(t["final"]) == 7  # start, s, st, t, and shared by all: before p, after p, after s


def test_token_counts_equal_the_library(spark):
    texts = odd_texts()
    lib = Tokenizer.from_file(BYTE_BPE)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in token_counts.count_tokens(docs, BYTE_BPE, limit=20, max_frequent=5000).collect():
        n = len(lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 20)
    found = {(r["doc_id"], r["n_tokens"]) for r in token_counts.count_tokens(frame(spark, EDGES), BYTE_BPE).collect()}
    assert (3, 0) in found and (4, 0) in found and len(found) == 9
    assert token_counts.count_tokens(none(spark), BYTE_BPE).count() == 0
    with pytest.raises(ValueError):
        token_counts.count_tokens(docs, WORD_BPE)


# --- exact copies, shards -------------------------------------------------------------------------------------------


def test_exact_copies(spark):
    found = exact_dedup.find_copies(frame(spark, EDGES), keep="max").collect()
    assert len(found) == len(EDGES)
    same = [r for r in found if r["text_sha256"] == hashlib.sha256(b"same text, here.").hexdigest()]
    assert len(same) == 4 and {r["keep_id"] for r in same} == {2} and {r["group_size"] for r in same} == {4}
    assert sum(r["kept"] for r in same) == 1 and [r["doc_id"] for r in same if r["kept"]] == [2]
    assert {r["keep_id"] for r in found if r["doc_id"] in (3, 4)} == {4}
    assert all(r["kept"] for r in found if r["doc_id"] in (5, 6, 7, 8))
    least = {r["keep_id"] for r in exact_dedup.find_copies(frame(spark, EDGES), keep="min").collect() if r["doc_id"] in (1, 2)}
    assert least == {1}
    assert exact_dedup.find_copies(none(spark)).count() == 0


def test_drop_copies_keeps_one_row_and_all_columns(spark):
    docs = frame(spark, EDGES)
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == [2, 4, 5, 6, 7, 8]


def test_exact_copies_with_a_hot_text(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(F.concat(F.lit("t"), F.col("id") % 997)).alias("text")).repartition(16)
    found = {r["doc_id"]: r for r in exact_dedup.find_copies(docs, keep="max").collect()}
    groups = {}
    for r in docs.collect():
        groups.setdefault(r["text"], []).append(r["doc_id"])
    assert all((found[i]["keep_id"], found[i]["group_size"], found[i]["kept"]) == (max(ids), len(ids), i == max(ids)) for ids in groups.values() for i in ids)


@pytest.mark.parametrize("limit", [200, 3000, 10**9])
def test_shards_against_brute_force(spark, limit):
    rnd = random.Random(5)
    rows = [(k, "x" * rnd.randint(0, 300)) for k in range(400)] + [(401, "y" * 5000), (402, None)] + [(403, "z" * 90)] * 4
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), max_shard_bytes=limit).collect()
    bits = {k: bin(int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16))[2:].zfill(60) for k, _ in rows}

    def shard(k):
        for depth in range(61):
            own = [(i, t) for i, t in rows if bits[i][:depth] == bits[k][:depth]]
            size = sum(len(t or "") for _, t in own)
            if size <= limit or len({i for i, _ in own}) == 1:
                return bits[k][:depth], size, len(own), size > limit

    assert len(found) == len(rows)
    assert all((r["shard"], r["shard_bytes"], r["shard_rows"], r["oversized"]) == shard(r["doc_id"]) for r in found)
    assert sharding.assign_shards(none(spark)).count() == 0


def test_shards_are_written(spark, tmp_path):
    docs = frame(spark, [(k, "x" * 50) for k in range(100)])
    directory = sharding.write_shards(docs, str(tmp_path / "out"), max_shard_bytes=800).collect()
    stored = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out"))
    assert stored.count() == 100 and sum(d["shard_rows"] for d in directory) == 100 and all(d["shard_bytes"] <= 800 for d in directory)


# --- toxicity -------------------------------------------------------------------------------------------------------


def toxic_rows(n=600):
    rnd = random.Random(7)
    clean = [f"w{k}" for k in range(300)]
    out = []
    for k in range(n):
        words = [rnd.choice("abcdefghij") + rnd.choice(clean).translate(str.maketrans("0123456789", "klmnopqrst")) for _ in range(40)]
        if k % 6 == 0:
            words.insert(rnd.randint(0, 39), "vilestem" + rnd.choice(["a", "en", "um", "ig"]))
        out.append((k, " ".join(words), int(k % 6 == 0)))
    return out


def test_toxicity_on_held_out_rows(spark):
    rows = toxic_rows()
    docs = spark.createDataFrame([(k, x) for k, x, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y, "z") for k, _, y in rows], "doc_id long, toxic int, lang string")
    model = toxicity.fit(docs, labels)
    found = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    for k, _, y in rows:
        assert found[k]["held_out"] == (zlib.crc32(str(k).encode()) % 5 == 0)
    held = [(y, found[k]["predicted"]) for k, _, y in rows if found[k]["held_out"]]
    assert sum(y == p for y, p in held) >= 0.97 * len(held) and all(not p for y, p in held if not y)
    again = toxicity.fit(docs.repartition(7), labels.repartition(3))
    assert (again.places == model.places).all() and (again.weights == model.weights).all()
    left = toxicity.drop_toxic(frame(spark, [(1, rows[0][1]), (2, rows[1][1]), (3, None), (None, "")]), model)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "3", "None"]


def plain_ftrl(rows, alpha=0.3, beta=1.0, l1=4.0, l2=0.1, epochs=3, seed=0):
    """The written update rules, one coordinate after the other."""
    import math

    import numpy as np

    z, n, ones = {}, {}, sum(y for _, y in rows)
    bias, bias_n = math.log((ones + 1) / (len(rows) - ones + 1)), 0.0

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            places, y = rows[k]
            places = sorted(set(places))
            w = {i: weight(i) for i in places}
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, bias + sum(w.values())))))
            g = p - y
            for i in places:
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
            bias_n += g * g
            bias -= alpha / (beta + math.sqrt(bias_n)) * g
    return {i: w for i in z if (w := weight(i))}, bias


def plain_features(text):
    """Words, their stems, neighbours and pairs with one word skipped, hashed one by one."""
    import xxhash

    mask, a, b, c = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
    h = lambda w, seed=0: xxhash.xxh3_64_intdigest(w, seed)
    words = re.findall(r"[^\W\d_]+", text.lower())
    out = {h(w) >> 44 for w in words} | {h(w[:k], k) >> 44 for w in words for k in toxicity.STEMS if len(w) >= k}
    return out | {((h(x) * b & mask ^ h(y) * c & mask ^ step) * a & mask) >> 44 for step in (1, 2) for x, y in zip(words, words[step:], strict=False)}


def test_toxicity_against_plain_ftrl(spark):
    """Features, the fit and the scores, by the written rules."""
    import math

    rows = toxic_rows(240)
    texts = [*(x for _, x, _ in rows), "", "one", "a B a b A", "Ärger straße 12 x_y"]
    features = toxicity.Features()
    assert all(set(features.of(x).tolist()) == plain_features(x) for x in texts)
    docs = spark.createDataFrame([(k, x) for k, x, _ in rows] + [(900 + k, x) for k, x in enumerate(texts[-4:])], "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(k, y) for k, _, y in rows], "doc_id long, toxic int"))
    learned = sorted((k, y, x) for k, x, y in rows if zlib.crc32(str(k).encode()) % 5)
    weights, bias = plain_ftrl([(plain_features(x), y) for _, y, x in sorted(learned, key=lambda r: r[:2])])
    assert dict(zip(model.places.tolist(), model.weights.tolist(), strict=True)) == pytest.approx(weights, rel=1e-5) and model.bias == pytest.approx(bias)
    for r in toxicity.score(docs, model).collect():
        text = dict(docs.collect())[r["doc_id"]]
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-bias - sum(weights.get(i, 0.0) for i in plain_features(text)))), rel=1e-4)


def test_toxicity_without_labels(spark):
    model = toxicity.fit(none(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert [(r["predicted"], 0 <= r["score"] <= 1) for r in toxicity.score(frame(spark, [(1, ""), (2, None)]), model).collect()] == [(0, True)] * 2


# --- pages ----------------------------------------------------------------------------------------------------------

LONG = "This is the first part of the article, and it is long enough to be judged by the rules, as it has the words of the language that they look for. "


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<script>x</script><style>y</style>", ""),
        ("<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>A &amp; B&amp</h1><p>One<br>two <b>th</b>ree\n\n four<p>five</article><footer>end</footer></body>", "A & B& One two three four five"),
        ("<body><article><p>Text</p><div class='ad'>Buy</div><form><p>Mail</p></form><aside>x</aside><div id=comments><p>Me</p></div><p>End</p></article></body>", "Text End"),
        (f"<div><h2>Head</h2><p>{LONG}</p><p>Short.</p><p>{LONG}</p></div><div class='site-footer'><p>{LONG}</p></div>", f"Head {LONG.strip()} Short. {LONG.strip()}"),
        (f"<ul><li><a href=1>One link</a><li><a href=2>Another</a></ul><p>{LONG}</p>", LONG.strip()),
        ("<article><!-- no --><p title='a>b'>x</p><noscript>n</noscript><p hidden>h</p><p>&lt;y&gt;</p>", "x <y>"),
    ],
)
def test_pages(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>One</p><svg class='icon'/><p>Two</p></article>", "One Two"),
        ("<article><p>One</p><svg/><p>Two</p><math /><p>Three</p><svg><text>x</text></svg><p>Four</p></article>", "One Two Three Four"),
        ("<article><p>One</p><svg width=1><p>Two</p><svg><template><p>Three</p></article>", "One Two Three"),
        ("<article><p>One</p><script>x <p>y</p></article>", "One"),
    ],
)
def test_pages_with_raw_elements_left_open(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize("wrapper", ["form", "div class='has-sidebar'", "div class='layout sidebar-right'", "div id=no-header", "section class='widget post'", "header", "aside"])
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_pages_within_a_wrapper(wrapper, inner):
    menu, name = "<div class=menu><p>Here</p></div><div class='sidebar'><p>Side</p></div>", wrapper.split()[0]
    page = f"<body><{wrapper}>{menu}<{inner}><p>{LONG}</p><p>{LONG}</p><div class=ad>Buy</div></{inner}><form><p>Mail</p></form></{name}><p>End</p></body>"
    kept = inner != "div" or name not in ("header", "aside")
    text = html_text.extract(page)
    assert (f"{LONG}{LONG}".strip() in text) == kept and not any(x in text for x in ("Buy", "Mail", "Here", "Side"))


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><p>{LONG}</p><div id=comments><p>{LONG * 4}</p><article class=comment><p>{LONG * 4}</p></article></div></article>", LONG.strip()),
        (f"<main><p>{LONG}</p></main><aside><article><p>Teaser</p></article></aside><div class=widget><article><p>Teaser</p></article></div>", LONG.strip()),
        (f"<article><p>{LONG}</p><form><fieldset><p>Mail</p></fieldset></form></article>", LONG.strip()),
    ],
)
def test_pages_with_marked_parts(page, text):
    assert html_text.extract(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<article><a href=1>Teaser</a></article><div><h2>Head</h2><p>{LONG * 2}</p><p>{LONG * 2}</p><p>Short</p><p>{LONG}</p></div><article><a href=2>Other</a></article>", f"Head {LONG * 4}Short {LONG.strip()}"),
        (f"<div><p>{LONG}</p><p>{LONG}</p></div><article><p>Note</p></article>", f"{LONG * 2}Note"),
        (f"<main><ul><li><a href=1>One link</a><li><a href=2>Another</a></ul><p>{LONG}</p><p>Short</p></main>", f"{LONG}Short"),
        (f"<article><h1><a href=1>Title</a></h1><p>{LONG}</p><p>Short, with <a href=2>a link</a></p></article><p>{LONG[:100]}</p>", f"Title {LONG}Short, with a link"),
        (f"<article><p>{LONG * 4}</p></article><p>Out</p><p>{LONG * 2}</p><p>Out</p>", (LONG * 6).strip()),
    ],
)
def test_pages_with_evidence_against_the_markup(page, text):
    assert html_text.extract(page) == text


def test_pages_of_the_tables(spark):
    import html

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r["page_id"]: r for r in html_text.extract_text(pages.withColumn("text", F.lit("x"))).collect()}
    for r in pages.collect():
        inner = re.search("<article>(.*?)</article>", r["html"], re.S)[1]
        expected = " ".join(html.unescape(re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))).split())
        assert (found[r["page_id"]]["text"], found[r["page_id"]]["n_chars"]) == (expected, len(expected))


# --- licences, URLs -------------------------------------------------------------------------------------------------


def test_licenses(spark):
    texts = {
        1: "Prose here.\nReleased under the MIT License.\nMore prose.", 2: "released UNDER the mit licence", 3: None, 4: "", 5: "All rights reserved. All rights reserved.", 6: "Nothing of the kind.",
        7: "Permission to use, copy, modify, and/or distribute this software\nfor any purpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nCode.",
        8: licenses.TEMPLATES["apache-2.0-header"] + "\n" + licenses.TEMPLATES["gpl-3.0"],
    }
    found = {r["doc_id"]: r for r in licenses.scan(frame(spark, texts.items())).collect()}
    assert len(found) == 8
    assert [found[k]["license"] for k in sorted(texts)] == ["mit", None, None, None, "all-rights-reserved", None, "isc", "apache-2.0-header"]
    assert [m["license"] for m in found[8]["matches"]] == ["apache-2.0-header", "gpl-3.0", "apache-2.0-header"] and found[1]["dice"] == 1.0
    assert licenses.scan(none(spark)).count() == 0
    for no in ({}, {"empty": "", "signs": "-- !"}):
        assert [tuple(r)[1:] for r in licenses.scan(frame(spark, [(1, "MIT"), (2, None)]), templates=no).collect()] == [([], None, None, 0)] * 2


def test_whole_licence_files(spark):
    """Files of several lines and paragraphs, with a copyright line, other line breaks, and numbers before conditions."""
    def wrapped(text, width):
        words = text.split()
        return "\n".join(" ".join(words[k : k + width]) for k in range(0, len(words), width))

    full = [n for n in licenses.TEMPLATES if n.endswith("-text")]
    docs = [(k, f"Copyright (c) 2020 Ann Dune\n\n{wrapped(licenses.TEMPLATES[n], 6 + k)}\n") for k, n in enumerate(full)]
    docs += [(100, "Copyright 2021\n\n" + licenses.TEMPLATES["mit-text"].replace("subject to", "\n\nsubject to") + "\n\nThe end of it."), (101, licenses.TEMPLATES["mit-text"] + " ".join(f" prose{k} of another kind{k}" for k in range(99)))]
    found = {r["doc_id"]: (r["license"], r["dice"]) for r in licenses.scan(frame(spark, docs)).collect()}
    assert [found[k][0] for k in range(len(full))] == full and all(found[k][1] > 0.9 for k in range(len(full)))
    assert found[100][0] in ("mit-text", "mit-permission") and found[101] == (None, None)
    assert len(full) >= 8


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_licenses_against_brute_force(spark, threshold):
    rnd = random.Random(11)
    templates = {f"t{k}": " ".join(rnd.choice("abcd") for _ in range(rnd.randint(1, 8))) for k in range(6)}
    texts = [(k, "\n".join(" ".join(rnd.choice("abcd") for _ in range(rnd.randint(0, 8))) for _ in range(3))) for k in range(200)]
    found = {r["doc_id"]: sorted((m["license"], m["dice"]) for m in r["matches"]) for r in licenses.scan(spark.createDataFrame(texts, "doc_id long, text string"), templates=templates, threshold=threshold).collect()}
    sets = {n: set(licenses.bigrams(t)) for n, t in templates.items()}
    for k, text in texts:
        expected = []
        for unit in dict.fromkeys(" ".join(x.split()) for x in [*text.split("\n"), *re.split("\n *\n", text), text]):
            grams = set(licenses.bigrams(unit))
            best = max(((2 * len(grams & s) / (len(grams) + len(s)), n) for n, s in sets.items()), key=lambda x: (x[0], [-ord(c) for c in x[1]])) if grams else (0, "")
            if best[0] >= threshold:
                expected.append((best[1], best[0]))
        assert found[k] == sorted(expected), text


def test_url_filter(spark):
    entries = spark.createDataFrame([("bad.org", "block", "2024-01-10"), ("bad.org", "allow", "2024-02-01"), ("ok.bad.org", "allow", "2024-01-01"), ("x.net", "block", "2024-01-05"), ("x.net", "allow", "2024-01-05"), (None, "block", "2024-01-01")], "domain string, action string, listed_on string")
    captures = spark.createDataFrame(
        [(1, "http://www.bad.org/a", "2024-01-09"), (2, "http://www.BAD.org./a", "2024-01-10"), (3, "https://u@bad.org:80", "2024-02-01"), (4, "http://ok.bad.org", "2024-01-20"), (5, "http://x.net?q", "2024-03-01"), (6, None, "2024-01-01"), (7, "nothing", "2024-01-01"), (8, "http://x.net", None), (5, "http://x.net?q", "2024-03-01")],
        "page_id long, url string, fetched_on string",
    )
    found = sorted((r["page_id"], r["entry"], r["blocked"]) for r in url_filter.match(captures.withColumn("domain", F.lit("z")), entries).collect() if r["page_id"])
    assert [x[2] for x in found] == [False, True, False, False, True, True, False, False, False]
    assert found[3][1] == "ok.bad.org" and found[0][1] is None
    assert sorted(r["page_id"] for r in url_filter.drop_blocked(captures, entries).collect()) == [1, 3, 4, 6, 7, 8]
    assert url_filter.match(captures, entries.limit(0)).where("blocked").count() == 0


# --- decontamination ------------------------------------------------------------------------------------------------


def brute_hits(text, items, n=10):
    words = re.findall(decontamination.WORD, (text or "").translate(LOWER))
    hit, found = set(), set()
    for item, body in items:
        w = re.findall(decontamination.WORD, (body or "").translate(LOWER))
        for k in range(max(1, len(w) - n + 1) if w else 0):
            own = w[k : k + n]
            for at in range(len(words) - len(own) + 1):
                if words[at : at + len(own)] == own:
                    hit.update(range(at, at + len(own)))
                    found.add(item)
    return len(words), len(hit), len(found)


@pytest.mark.parametrize("block", [500_000, 7])
def test_decontamination_against_brute_force(spark, block):
    rnd = random.Random(13)
    text = lambda n: " ".join(rnd.choice("ab") for _ in range(n))
    items = [(1, text(14)), (2, "Aa, b"), (3, None), (4, ""), (5, text(10)), (6, "a b a b a b a b b b"), (6, "a b a b a b a b b b")]
    docs = [(k, text(rnd.randint(0, 200))) for k in range(40)] + [(90, None), (91, ""), (92, "AA b"), (92, "AA b"), (None, "aa B")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find_contamination(frame(spark, docs), bench, block_windows=block).collect()
    mine = sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], sum(s["length"] for s in r["spans"])) for r in found)
    assert mine == sorted((str(k), *(h := brute_hits(x, items)), h[1]) for k, x in docs)
    left = decontamination.drop_contaminated(frame(spark, docs), bench, block_windows=block)
    assert sorted(str(r["doc_id"]) for r in left.collect()) == sorted(str(k) for k, x in docs if not brute_hits(x, items)[1])  # by row, whatever the id
    assert left.columns == frame(spark, docs).columns
    cut = decontamination.cut_spans(frame(spark, docs), spark.createDataFrame([(2, "Aa, b")], "item_id long, text string"))
    assert all(brute_hits(r["text"], [(2, "aa b")])[1] == 0 for r in cut.collect())


def test_cuts_do_not_depend_on_blocks(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = frame(spark, [(1, f"Before. {item}, after"), (2, "w0 w1 x y"), (3, None), (4, ""), (5, "p q a b c d r s"), (6, item)])
    bench = spark.createDataFrame([(1, item), (2, "a b c d"), (3, "q r s")], "item_id long, text string")

    def cut(block_windows):
        return {r["doc_id"]: r["text"] for r in decontamination.cut_spans(docs, bench, block_windows=block_windows).collect()}

    assert cut(500_000) == {1: "Before. \n, after", 2: "w0 w1 x y", 3: None, 4: "", 5: "p q \n r s", 6: "\n"}
    assert cut(1) == cut(7) == cut(500_000)


def test_decontamination_without_items(spark):
    bench = spark.createDataFrame([], "item_id string, text string")
    assert [r["contaminated"] for r in decontamination.find_contamination(frame(spark, [(1, "a b")]), bench).collect()] == [False]
    assert decontamination.find_contamination(none(spark), bench).count() == 0


# --- near copies ----------------------------------------------------------------------------------------------------


def brute_components(docs, size=5, percent=80):
    sets, root = {}, {}
    for i, x in docs:
        w = re.findall(near_dedup.WORD, (x or "").translate(LOWER))
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
        root[i] = i

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def near_docs(n=260):
    """Groups of copies with a few words changed, one of them large, and lone texts."""
    rnd = random.Random(17)
    word = lambda: "".join(rnd.choice("abcdefghijklmnop") for _ in range(4))
    base = [[word() for _ in range(rnd.randint(30, 120))] for _ in range(12)]
    docs = [(900, None), (901, ""), (902, "a B c"), (903, "A b C"), (904, "a b"), (905, " \t")]
    for k in range(n):
        words = list(base[0 if k % 2 else k % 12])
        for _ in range(rnd.randint(0, 5)):
            words[rnd.randrange(len(words))] = word()
        docs.append((k, " ".join(words).title() if k % 5 else " ".join(words)))
    return docs


@pytest.mark.parametrize(("percent", "chunk"), [(85, 256), (80, 16), (92, 5)])
def test_near_copies_against_brute_force(spark, monkeypatch, percent, chunk):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    docs = near_docs()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dedup.find_near_copies(frame(spark, docs), percent=percent).collect()}
    assert found == brute_components(docs, percent=percent)
    assert len({c for _, c, _ in found.values()}) < len(found)


def test_near_copies_edges(spark):
    docs = frame(spark, [*EDGES, (None, "lone")])
    found = near_dedup.find_near_copies(docs).collect()
    assert len(found) == 11
    same = [r for r in found if r["n_shingles"] == 1 and r["component_id"] == 1]
    assert len(same) == 4
    left = near_dedup.drop_near_copies(docs)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {None, 1, 3, 4, 5, 6, 7, 8}
    assert near_dedup.find_near_copies(none(spark)).count() == 0


def test_estimate_corrects_for_collisions():
    rnd = random.Random(19)
    for similarity in (0.3, 0.6, 0.9):
        estimates = []
        for _ in range(60):
            a = {rnd.getrandbits(63) for _ in range(400)}
            common = round(400 * 2 * similarity / (1 + similarity))
            b = set(sorted(a)[:common]) | {rnd.getrandbits(63) for _ in range(400 - common)}
            import numpy as np

            with np.errstate(over="ignore"):
                marks = [np.frombuffer(near_dedup.signature(near_dedup.minima(np.array(sorted(s), np.uint64))), np.uint8) for s in (a, b)]
            estimates.append(near_dedup.estimate(near_dedup._EQUAL[marks[0] ^ marks[1]].sum(dtype=int)))
        assert abs(sum(estimates) / 60 - similarity) < 0.03


def test_components(spark):
    rnd = random.Random(23)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 180)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(150)] + [(5, 5), (None, 3)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: find(i) for i in root}


# --- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    learned = sorted((r["doc_id"], r["toxic"]) for r in labels if zlib.crc32(str(r["doc_id"]).encode()) % 5 and r["doc_id"] in texts)
    weights, bias = plain_ftrl([(plain_features(texts[i]), y) for i, y in learned])
    toxic = {i for i, x in texts.items() if bias + sum(weights.get(k, 0.0) for k in plain_features(x)) >= 0}
    assert toxic
    left = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] not in toxic}
    groups = {}
    for i, x in left.items():
        groups.setdefault(x.translate(LOWER), []).append(i)
    left = {max(ids): left[max(ids)] for ids in groups.values()}
    left = {i: left[i] for i, (_, _, kept) in brute_components(list(left.items())).items() if kept}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[k : k + 10]) for _, x in items if (w := re.findall(decontamination.WORD, x.translate(LOWER))) for k in range(max(1, len(w) - 9))}
    lengths = {len(w) for w in windows}

    def clean(text):
        w = re.findall(decontamination.WORD, text.translate(LOWER))
        return not any(tuple(w[k : k + n]) in windows for n in lengths for k in range(len(w) - n + 1))

    lib = Tokenizer.from_file(WORD_BPE)
    expected = {i: lib.encode(x, add_special_tokens=False).ids for i, x in left.items() if clean(x)}
    assert {r["doc_id"]: r["ids"] for r in corpus_pipeline.run(spark, SF).collect()} == expected
    assert 0 < len(expected) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
