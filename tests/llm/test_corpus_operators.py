"""The corpus operators against plain versions, on a table with every kind of odd row."""

import html
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from lakekit.llm import (
    ann,
    backoff,
    chat,
    components,
    encoding,
    html_extract,
    mixing,
    ngram_join,
    packing,
    quality_rules,
    token_files,
    trie_counts,
    words,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, source string, size string, kept string, n_tokens long"


def _rows():
    draw = random.Random(5)
    names = ["alpha", "beta", "The", "the", "été", "x,", "of%%%", "don't", "中文", "a" * 40]
    prose = [" ".join(draw.choice(names) + str(draw.randint(0, 60)) for _ in range(90)) for _ in range(6)]
    near = prose[0].replace("alpha", "gamma", 1)
    texts = [*prose, prose[0], near, None, "", " \n\t ", "one", "one two", "same line\nsame line\n",
             "a b c d", "a b c d e", "word " * 120, " ".join(f"w{i}" for i in range(30_000)), prose[1].upper()]
    rows = [(i, t, None if i % 5 == 4 else f"s{i % 3}", "x", "y", 1) for i, t in enumerate(texts)]
    return [*rows, rows[2], rows[2], (None, prose[3], "s1", "x", "y", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def _set(text):
    found = WORD.findall(_low(text))
    if len(found) < 5:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + 5]) for i in range(len(found) - 4))


def test_encoder_equals_the_library():
    draw = random.Random(3)
    parts = [" ", "  ", "\n", "a", "Bc", "'s", ".", "12", "é", "क़", "İ.", "Σ", "\xa0", "中", "%%%", "|", "🙂",
             "<|endoftext|>", " ", "\x1c"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 12))) for _ in range(4000)]
    for path in (BYTES, WORDS):
        with open(path, encoding="utf-8") as file:
            encoder = encoding.Encoder(file.read())
        ids, counts = encoder.encode(pa.array(texts))
        got = np.split(ids, np.cumsum(counts)[:-1])
        assert all(np.array_equal(a, b) for a, b in zip(got, encoder.plain(texts), strict=True))


def test_pairs_of_near_copies_are_found_once(spark, monkeypatch):
    """Copies with a few other words each meet in many buckets; a pair comes from one of them."""
    draw = random.Random(8)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(400)]
    texts = []
    for _ in range(40):
        own = list(base)
        for i in draw.sample(range(400), 4):
            own[i] = f"x{draw.randint(0, 10**6)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _, classes, meetings = ngram_join._prepared(docs)
    each = meetings.select("bucket", "cls", F.col("cls").alias("comp"))
    pairs = [tuple(r) for r in ngram_join._searched(each, classes).collect()]
    in_buckets = meetings.groupBy("bucket").count().selectExpr("sum(count * (count - 1) div 2)").first()[0]
    assert in_buckets > 10 * len(pairs) and len(pairs) < 2 * len(set(pairs))
    # All links are among them, however few cells a class names.
    sets = [_set(t) for t in texts]
    want = sum(5 * len(a & b) >= 4 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert want > 0
    for named in (32, 1):
        monkeypatch.setattr(ngram_join, "NAMED_CELLS", named)
        assert ngram_join.jaccard_links(docs)[0].distinct().count() == want


def test_jaccard_groups(spark, docs, empty):
    rows = _rows()
    sets = [_set(r[1]) for r in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    want = Counter((r[0], len(s), least[g] if s else r[0]) for r, s, g in zip(rows, sets, group, strict=True))
    got = Counter(tuple(r) for r in ngram_join.jaccard_groups(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == want
    kept = [r["doc_id"] for r in ngram_join.deduplicated(docs).collect()]
    assert 0 in kept and 6 not in kept and 7 not in kept and kept.count(2) == 1 and 8 in kept
    assert ngram_join.jaccard_groups(empty).count() == 0


def test_no_link_is_lost_by_keys_or_tree():
    draw = np.random.default_rng(1)
    base = draw.integers(0, 1 << 63, 4000, dtype=np.uint64)
    for n in (1, 3, 4, 5, 9, 20, 77, 300, 1500):
        a = np.sort(base[:n])
        for gone in range(0, max(1, n // 5) + 1, max(1, n // 20)):
            b = np.sort(np.concatenate([base[gone:n], base[2000 : 2000 + draw.integers(0, 3)]]))
            if not ngram_join.linked(a, b):
                continue
            counts = np.array([len(a), len(b)])
            hashes = np.concatenate([a, b])
            keys, holder, _, need = ngram_join.group_keys(hashes, counts)
            shared = set(keys[holder == 0].tolist()) & set(keys[holder == 1].tolist())
            assert len(shared) >= 1
            points = ngram_join.count_vectors(hashes, counts)
            assert 1 in ngram_join.CountTree(points, counts).within(points[0], counts[0])
    points = draw.poisson(3, (500, ngram_join.DIMENSIONS))
    sizes = points.sum(axis=1)
    tree = ngram_join.CountTree(points, sizes)
    for i in range(0, 500, 50):
        bound = np.minimum(points, points[i]).sum(axis=1)
        want = np.flatnonzero(bound * 9 >= 4 * (sizes + sizes[i]))
        assert set(want) <= set(tree.within(points[i], sizes[i]).tolist())


def test_shingles_do_not_depend_on_the_batch():
    texts = [r[1] for r in _rows()]
    hashes, counts = words.shingle_sets(pa.array(texts), 5)
    assert counts.tolist() == [len(_set(t)) for t in texts]
    one, n = words.shingle_sets(pa.array([texts[3]]), 5)
    at = counts[:3].sum()
    assert np.array_equal(one, hashes[at : at + n[0]])


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7), (None, 3)], "a long, b long")
    got = {r["vertex"]: r["component"] for r in components.components(edges).collect()}
    assert got == {**{i: 1 for i in range(2, 41)}, 101: 100}


def test_nearest(spark):
    draw = np.random.default_rng(2)
    vectors = draw.standard_normal((300, 16)).astype(np.float32)
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(300, None, "x"), (301, [0.0] * 16, "x"), (302, [float("nan")] * 16, "x"), (303, [1.0, 2.0], "x")]
    rows += [(304, vectors[3].tolist(), "x"), (None, vectors[3].tolist(), "x"), rows[5]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    found = ann.nearest(frame, frame.filter("vec_id % 20 = 0"), 10, entry_share=100.0).collect()
    fit = {r[0]: np.array(r[1], dtype=np.float64) for r in rows if r[0] is not None and (r[0] < 300 or r[0] == 304)}
    for q in range(0, 300, 20):
        want = sorted((-(v * fit[q]).sum(), i) for i, v in fit.items() if i != q)[:10]
        got = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [(i, -s) for s, i in want] == [(i, s) for _, i, s in got]
    assert ann.nearest(frame.limit(0), frame.limit(0), 10).count() == 0


PAGE = (
    "<html><head><title>T</title><script>var a='</p>';</script></head><body><nav><ul><li><a href=/>Home</a></ul></nav>"
    "<article><h1>A &amp; B</h1><p>First  paragraph of the\ntext, long enough to be one. It has two sentences.<p>Second "
    "one, <b>bold</b> too. It ends here, with a stop.</p><div class='comments'><p>I like it!</p></div></article>"
    "<footer>&copy; someone</footer>"
)


def test_extract(spark):
    pages = [(i, f"u{i}", PAGE.replace("First", f"First {i}"), 1) for i in range(40)] + [(40, None, None, 1), (41, "u", "", 1)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string, text long")
    got = {r["page_id"]: r for r in html_extract.extract(frame).collect()}
    assert got[3]["text"] == (
        "A & B\nFirst 3 paragraph of the text, long enough to be one. It has two sentences.\n"
        "Second one, bold too. It ends here, with a stop."
    )
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())
    assert got[40]["text"] == got[41]["text"] == ""
    assert html_extract.extract(frame.limit(0)).count() == 0


def test_features_of_long_pages_are_whole():
    long = "plain words, " * 60 + "ÀÉ AB ٣4 x " * 500
    page = f"<body><h2>x</h2>{'<p>One.</p>' * 400}<div>advert</div><p>{long}</p></body>"
    nodes, _, x = html_extract.describe(html_extract.parse(page))
    at = {name: x[:, k] for k, name in enumerate(html_extract.FEATURES)}
    rows = {n.tag: i for i, n in enumerate(nodes) if n.above is not None and n.above.tag == "body"}
    # A heading, 400 short paragraphs, an advert and a long paragraph.
    assert at["like_siblings"][rows["div"]] == at["like_siblings"][rows["h2"]] == 1 / 403
    assert at["like_siblings"][rows["p"]] == 401 / 403
    for name, count in (("capitals", str.isupper), ("digits", str.isdigit)):
        text = " ".join(long.split())
        assert at[name][rows["p"]] == sum(map(count, text)) / len(text)


def _shown(page):
    return [n.text for n in html_extract.describe(html_extract.parse(page))[0] if n.text is not None]


def test_broken_markup_loses_no_text():
    assert _shown("<article><p title=it's>Hello world</p><p>don't stop</p></article>") == ["Hello world", "don't stop"]
    assert _shown('<p title="a > b" x=\'>\'>one</p><p y="two>three') == ["one", "three"]
    assert _shown("<head><title>t</title><p>in the body</p>") == ["in the body"]
    assert _shown("1 < 2 <p>cut <a href") == ["1 < 2", "cut <a href"]
    # Numbers with thousands of digits are one character, or the one behind leading zeros.
    assert _shown(f"<p>x&#{'9' * 6000};y&#{'0' * 6000}65;&#65;") == ["x\ufffdyAA"]


@pytest.mark.parametrize(
    "page",
    ["<div>" * 50_000 + "x", '<a "' * 100_000, "<a x='" * 100_001 + ">x", "<b>" * 50_000 + "</i>" * 50_000 + "x",
     "<ul><li>" + "<div>" * 20_000 + "<li>x" * 20_000, "<a " + "x" * 300_000 + ">x", "<!x" * 100_000, "<p x='\">x" * 30_000],
)
def test_hostile_pages_take_linear_time(page):
    start = time.process_time()
    html_extract.describe(html_extract.parse(page))
    assert time.process_time() - start < 5


def test_pages_share_the_array_work():
    pages = [PAGE, "", "<p>x", PAGE.replace("nav", "div"), "<h1>late</h1>"]
    nodes, above, x = html_extract.describe(*map(html_extract.parse, pages))
    at = 0
    for page in pages:
        own, own_above, own_x = html_extract.describe(html_extract.parse(page))
        assert [n.text for n in own] == [n.text for n in nodes[at : at + len(own)]]
        assert [a + at if a >= 0 else -1 for a in own_above] == above[at : at + len(own)]
        assert np.array_equal(own_x, x[at : at + len(own)])
        at += len(own)
    assert at == len(nodes)


def test_extract_of_pages_held_out_of_training(spark):
    """Trees from pages of one table, texts of another one's pages that are not among them."""
    taught, asked = (spark.read.parquet(f"/root/testdata/{sf}/pages.parquet") for sf in ("sf0.001", "sf0.01"))
    asked = asked.join(taught.select("html"), "html", "left_anti")
    pages = {r["page_id"]: r["html"] for r in asked.collect()}
    got = {r["page_id"]: r["text"] for r in html_extract.extract(asked, html_extract.train(taught)).collect()}
    assert len(pages) > 100 and pages.keys() == got.keys()
    right = 0
    for i, page in pages.items():
        article = page[page.index("<article>") : page.index("</article>")]
        blocks = re.split(r"</?(?:p|h\d|ul|ol|li|blockquote|pre|div|table|tr|td)\b[^>]*>", article)
        plain = [" ".join(html.unescape(re.sub(r"<br>", " ", b)).split()) for b in (re.sub(r"<(?!br)[^>]*>", "", b) for b in blocks)]
        right += got[i] == "\n".join(b for b in plain if b)
    assert right >= 0.97 * len(pages)


def test_decoding_keeps_nothing_below_what_it_drops():
    draw = np.random.default_rng(4)
    for _ in range(50):
        n = int(draw.integers(2, 9))
        above = [-1] + [int(draw.integers(0, i)) for i in range(1, n)]
        odds = draw.standard_normal(n)
        best = max(
            sum(o if x >> i & 1 else -o for i, o in enumerate(odds))
            for x in range(1 << n)
            if all(not x >> i & 1 or above[i] < 0 or x >> above[i] & 1 for i in range(n))
        )
        kept = html_extract.decode(above, odds)
        assert all(not k or a < 0 or kept[a] for k, a in zip(kept, above, strict=True))
        assert math.isclose(best, sum(o if k else -o for k, o in zip(kept, odds, strict=True)))


def test_chat_texts(spark):
    rows = [(1, 0, "user", "hi"), (2, 0, "user", "hi"), (2, 1, "bot", "a <|end|> b"), (3, 0, "user", "hi"), (3, 1, "bot", "a <|end|> b"),
            (4, 0, None, None), (4, 0, None, None), (5, 1, "bot", "a <|end|> b"), (5, 0, "bot", "hi"), (None, 0, "user", "x")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in chat.chat_texts(frame).collect()}
    assert set(got) == {2, 4, 5, None}
    assert got[2] == (2, "<|user|>\nhi\n<|end|>\n<|bot|>\na < |end|> b\n<|end|>\n")
    assert got[4] == (1, "<||>\n\n<|end|>\n")
    assert chat.chat_texts(frame.limit(0)).count() == 0


def _ids(path, texts, end):
    with open(path, encoding="utf-8") as file:
        plain = encoding.Encoder(file.read()).plain([t or "" for t in texts])
    return [np.append(x, end).astype("<u4") for x in plain]


def test_blocks_round_trip():
    draw = np.random.default_rng(6)
    for width, top in ((2, 1 << 16), (4, 1 << 20)):
        for n in (1, 7, 8, 1000):
            ids = draw.integers(0, top, n).astype(np.uint32)
            for planes in ("bit", "byte", "best"):
                assert np.array_equal(token_files.decode_block(token_files.encode_block(ids, width, planes)), ids)
    for a, b in ((b"", b"x"), (b"abc", b""), (b"abc", b"q" * 1000)):
        assert token_files.joined_crc32(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files(spark, docs, empty, tmp_path):
    path = f"{tmp_path}/ids"
    token_files.write_ids(docs, path, tokenizer=WORDS, end_id=2, block_ids=1000)
    got = token_files.read_checksums(spark, path).collect()
    rows = _rows()
    ids = _ids(WORDS, [r[1] for r in rows], 2)
    want = Counter((r[0], len(x), zlib.crc32(x)) for r, x in zip(rows, ids, strict=True))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    known = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"]) if r["doc_id"] is not None]
    assert known == sorted(known)
    assert token_files.chunk_index(spark, path).agg({"n_ids": "sum"}).first()[0] == at
    token_files.write_ids(empty, f"{path}-none", tokenizer=WORDS, end_id=2)
    assert token_files.read_checksums(spark, f"{path}-none").count() == 0


def test_mix(spark, docs, empty):
    columns = ["doc_id", "text", "source"]
    got = mixing.mix(docs.select(*columns)).collect()
    sizes = Counter()
    for _, text, source, *_ in _rows():
        sizes[source] += len(WORD.findall(text or ""))
    order = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        total = sum(min(2 * sizes[s], level * weight[s]) for s in order)
        low, high = (level, high) if total < 1.5 * sum(sizes.values()) else (low, level)
    taken = Counter()
    for r in got:
        assert r["size"] == len(WORD.findall(r["text"] or "")) and r["taken"] <= 2 * r["size"]
        assert math.isclose(r["target"], min(2 * sizes[r["source"]], low * weight[r["source"]]), rel_tol=1e-6)
        taken[r["source"]] += r["taken"]
    longest = {s: max(r["size"] for r in got if r["source"] == s) for s in order}
    for r in got:
        # Documents are taken whole, and none would bring the source nearer to its target.
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        assert abs(taken[r["source"]] - r["target"]) <= longest[r["source"]] / 2 + 1
    again = mixing.mix(docs.select(*columns).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))
    out = mixing.materialize(mixing.mix(docs.select(*columns)))
    texts = Counter(r["text"] for r in out.collect())
    assert all(n <= 2 * sum(r["text"] == t for r in got) for t, n in texts.items())
    assert sum(len(WORD.findall(r["text"])) for r in out.collect()) == sum(taken.values())
    assert mixing.mix(empty.select(*columns)).count() == 0


def test_quality_rules(spark, docs, empty):
    trusted = spark.createDataFrame([(0,), (1,), (None,)], "doc_id long")
    frame = docs.select("doc_id", "text", "source")
    rows = quality_rules.judge(frame, trusted).collect()
    assert len(rows) == len(_rows())
    for r in rows:
        found = WORD.findall(r["text"] or "")
        runs = [tuple(found[i : i + 3]) for i in range(len(found) - 2)]
        times = Counter(runs)
        covered = {k for i, run in enumerate(runs) if times[run] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in (r["text"] or "").split("\n") if WORD.search(x)]
        assert r["n_words"] == len(found) and r["word_chars"] == sum(map(len, found))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in r["text"] or "")
        assert r["n_dup_lines"] == len(lines) - len(set(lines)) and r["n_repeat_words"] == len(covered)
        assert r["base_failed"] == (len(found) < 50 or 100 * len(covered) > 50 * len(found))
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD)
    assert quality_rules.judge(empty.select("doc_id", "text"), trusted).count() == 0


def test_quality_rules_keep_their_ratios_out_of_the_plans(spark, docs):
    """The driver keeps the text of every plan, so numbers of all buckets in them fill its memory."""
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).limit(5)
    judged = quality_rules.judge_labelled(docs.select("doc_id", "text").limit(20), labels)
    assert len(judged._jdf.queryExecution().toString()) < 8 * quality_rules.BUCKETS


def test_quality_rules_count_every_hashed_ngram(spark):
    texts = ["", " a", "a b a", None, "b c\t\x0bd\x85e \xa0f", "wörter 中文 wörter"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    hashes = quality_rules.word_hashes(quality_rules.word_array(F.col("text")))
    counts = dict.fromkeys(range(64), 0)
    chosen = dict.fromkeys(range(64), 0)
    for i, grams in frame.select("doc_id", quality_rules.hashed_ngrams(hashes, 64)).collect():
        for g in grams:
            counts[g] += 1
            chosen[g] += i == 2
    n, t, prior = sum(counts.values()), sum(chosen.values()), quality_rules.PRIOR * 64
    shares = [(counts[g] + quality_rules.SMOOTHING) / (n + quality_rules.SMOOTHING * 64) for g in range(64)]
    want = [math.log((chosen[g] + prior * s) / (t + prior)) - math.log(s) for g, s in enumerate(shares)]
    found = quality_rules.log_ratios(frame, frame.filter("doc_id = 2"), buckets=64).first()
    assert found["ratios"] == pytest.approx(want)


def test_quality_rules_keep_unseen_good_documents_and_drop_toxic_ones(spark):
    draw = random.Random(8)
    names = [f"w{i}" for i in range(40)]
    junk = [f"{i}###" for i in range(40)]
    def text(source, n=400):
        return " ".join(draw.choice(source) for _ in range(n))
    rows = [(i, text(names), 1, 0) for i in range(60)]
    # One bad word in a long text, in different forms.
    rows += [(100 + i, f"{text(names)} {'Vile, vile! VILE vile.'.split()[i % 4]} {text(names)}", 1, 1) for i in range(20)]
    rows += [(200 + i, text(junk), 0, 0) for i in range(20)]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    # Labels for a part of each kind; the others are judged unseen.
    labels = spark.createDataFrame([(r[0], *r[2:]) for r in rows if r[0] % 2], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"] for r in quality_rules.judge_labelled(frame, labels).filter("kept").collect()}
    assert kept == set(range(60))
    assert quality_rules.judge_labelled(frame, labels.limit(0)).filter("kept").count() == 100
    assert quality_rules.judge_labelled(frame.limit(0), labels).count() == 0


def test_quality_rules_learn_from_all_trusted_documents(spark):
    """The fit takes every one of them, and the threshold the lowest score of all, each unseen."""
    draw = random.Random(9)
    names = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(draw.choice(names) for _ in range(80))) for i in range(40)]
    rows += [(100 + i, " ".join(f"odd{i}x{j}" for j in range(60))) for i in range(10)]
    rows += [(200 + i, " ".join(f"j{draw.randrange(30)}" for _ in range(300))) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], 1, 0) for r in rows if r[0] < 200], "doc_id long, quality int, toxic int")
    found = quality_rules.log_ratios(frame, labels.select("doc_id"), parts=3, buckets=64).first()
    parts = {r[0]: r[1] for r in frame.select("doc_id", quality_rules._part(3)).collect()}
    for p, got in enumerate([found["ratios"], *found["without"]], -1):
        ids = spark.createDataFrame([(i,) for i in parts if i < 200 and parts[i] != p], "doc_id long")
        assert got == pytest.approx(quality_rules.log_ratios(frame, ids, buckets=64).first()["ratios"])
    # Each odd text has words of its own, so only its own score can keep it.
    kept = {r["doc_id"] for r in quality_rules.judge_labelled(frame, labels).filter("kept").collect()}
    assert kept >= {r[0] for r in rows if r[0] < 200}


def test_backoff(spark, docs, empty):
    rows = _rows()
    texts = [[*WORD.findall(_low(r[1])), "</s>"] for r in rows]
    uni, pairs, context = Counter(), Counter(), Counter()
    for r, t in zip(rows, texts, strict=True):
        if not backoff.held_out(r[0]):
            uni.update(t)
            for pair in zip(["<s>", *t], t, strict=False):
                pairs[pair] += 1
                context[pair[0]] += 1
    def of(c):
        return backoff.discounts(np.array([sum(v == k for v in c.values()) for k in range(1, 7)]))
    du, dp, n = of(uni), of(pairs), sum(uni.values())
    def cut(c, d):
        return c * d[c] if c <= 5 else c
    left = max(n - sum(cut(c, du) for c in uni.values()), 1.0)
    whole = sum(cut(c, du) for c in uni.values()) + left
    def p1(w):
        return (cut(uni[w], du) if uni[w] else left) / whole
    follow: dict = {}
    for (h, w), c in pairs.items():
        follow.setdefault(h, []).append((w, c))
    def p2(h, w):
        c = pairs.get((h, w), 0)
        if c:
            return cut(c, dp) / (context[h] + 1)
        seen = follow.get(h, [])
        rest = 1 - sum(cut(c, dp) for _, c in seen) / (context[h] + 1)
        return rest / (1 - sum(p1(w) for w, _ in seen)) * p1(w)
    for h in ["<s>", "the", "a"]:
        every = sum(p2(h, w) for w in uni) + p2(h, "never seen")
        assert math.isclose(every, 1, rel_tol=1e-9)
    want = sorted((r[0] if r[0] is not None else -1, len(t), sum(uni[w] > 0 for w in t), round(sum(math.log10(p2(*x)) for x in zip(["<s>", *t], t, strict=False)), 5),
                   round(sum(math.log10((uni[w] + 1) / (n + len(uni) + 1)) for w in t), 5)) for r, t in zip(rows, texts, strict=True))
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], round(r["score"], 5), round(r["base_score"], 5)) for r in backoff.score(docs).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(math.isclose(a, b, abs_tol=2e-4) for g, w in zip(got, want, strict=True) for a, b in zip(g[3:], w[3:], strict=True))
    assert backoff.score(empty).count() == 0


def test_trie_counts(spark, docs, empty):
    scores = {"▁": -3.0, "▁a": -1.0, "b": -1.0, "ab": -2.0, "▁ab": -2.0, "c": -1.5, "bc": -1.0}
    def best(text, at=0):
        if at == len(text):
            return 0.0, 0
        options = [(scores[text[at:e]], 1, e) for e in range(at + 1, len(text) + 1) if text[at:e] in scores]
        n = len(text[at].encode())
        options.append(((-3.0 + trie_counts.UNCOVERED) * n, n, at + 1))
        found = [(s + best(text, e)[0], -(k + best(text, e)[1])) for s, k, e in options]
        top = max(found)
        return top[0], -top[1]
    samples = ["a", "ab", "abc", "abcbc", "xé", "", "cab", "abx", "bb"]
    assert trie_counts.trie_counts(samples, scores) == {w: best("▁" + w)[1] for w in samples}
    model = public_tokenizers.path("piece_bpe_32k.model")
    pieces = trie_counts.read_pieces(model)
    got = Counter((r["doc_id"], r["n_words"], r["n_tokens"]) for r in trie_counts.count_tokens(docs, model_file=model).collect())
    want = Counter()
    for doc_id, text, *_ in _rows():
        found = WORD.findall(text or "")
        counts = trie_counts.trie_counts(found, pieces)
        want[doc_id, len(found), sum(counts[w] for w in found)] += 1
    assert got == want
    assert trie_counts.count_tokens(empty, model_file=model).count() == 0


def test_trie_counts_equal_the_library():
    from sentencepiece import SentencePieceProcessor

    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces, model = trie_counts.read_pieces(path), SentencePieceProcessor(model_file=path)
    draw = random.Random(9)
    parts = ["the", "tion", "er", "a", "S", "é", "中", "🙂", "12", ".", "ß", "ing", "%%", "\xa0", "aaaa", "▁", "ê", "un"]
    samples = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 9))) for _ in range(3000)]
    samples += [w for r in _rows() for w in WORD.findall(r[1] or "")]
    got = trie_counts.trie_counts(samples, pieces)
    assert {w: n for w, n in got.items() if n != len(model.encode(w))} == {}


def test_pack(spark, docs, empty):
    pieces = packing.pack(docs, tokenizer=BYTES, end_id=1, sequence=64, window_sequences=4, digest=True).collect()
    rows = _rows()
    ids = _ids(BYTES, [r[1] for r in rows], 1)
    assert sum(r["length"] for r in pieces) == sum(map(len, ids))
    known = {(r[0], len(x)): x for r, x in zip(rows, ids, strict=True)}
    for r in pieces:
        text = known[r["doc_id"], r["doc_tokens"]]
        assert zlib.crc32(text[r["start"] : r["start"] + r["length"]]) == r["ids_crc32"]
    covered = Counter((r["doc_id"], r["doc_tokens"], r["start"] + k) for r in pieces for k in range(r["length"]))
    copies = Counter((r[0], len(x)) for r, x in zip(rows, ids, strict=True))
    assert all(n == copies[d, t] for (d, t, _), n in covered.items())
    filled = {}
    for r in sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == filled.get(r["sequence_id"], 0)
        filled[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(filled[s] == 64 for s in range(max(filled))) and sorted(filled) == list(range(max(filled) + 1))
    assert packing.pack(empty, tokenizer=BYTES, end_id=1).count() == 0


def test_summed_ratios_are_those_of_the_ngrams(spark):
    texts = ["", " a", "a b", "a b a b c\t\x0bd\x85e \xa0f", "wörter 中文 wörter"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for buckets in (64, 60):
        ratios = F.transform(F.sequence(F.lit(0), F.lit(buckets - 1)), lambda g: F.log(g + 2.0))
        hashes = quality_rules.word_hashes(quality_rules.word_array(F.col("text")))
        grams = quality_rules.hashed_ngrams(hashes, buckets)
        plain = F.aggregate(grams, F.lit(0.0), lambda total, g: total + F.get(ratios, g))
        summed = quality_rules._summed_ratios(hashes, ratios, buckets)
        for got, want, n, words in rows.select(summed, plain, F.size(grams), F.size(hashes)).collect():
            assert got == pytest.approx(want) and n == 2 * words
    counted = quality_rules.measure(rows).select("word_chars").collect()
    assert [r[0] for r in counted] == [len("".join(WORD.findall(t))) for t in texts]
