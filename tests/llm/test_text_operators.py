"""Operators on texts against plain Python versions, and the awkward rows each must take."""

from __future__ import annotations

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from llm import op1_html, op2_lines, op3_bpe, op5_decontaminate, op6_simhash, op10_substrings

SMALL = "/root/testdata/sf0.001"
LONG = " ".join(f"wort{k % 997} and{k % 13}" for k in range(30_000))
ODD = [
    (1, "The cat sat.\n\nThe cat sat.\nÄ b c"),
    (1, "The cat sat.\n\nThe cat sat.\nÄ b c"),
    (2, None),
    (3, ""),
    (None, "the cat sat. again and again it did so on the mat"),
    (4, "   \n\t "),
    (5, LONG),
    (6, LONG + " end"),
    (1, "another text under the same id"),
    (7, "<|endoftext|> don't x's"),
]
CLASH = "doc_id long, text string, n_chars int, fingerprint string, key int, doc int, place int, words string, digest int"


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, len(t or ""), "f", 1, 2, 3, "w", 4) for i, t in ODD]
    return spark.createDataFrame(rows, CLASH)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", low(text))


def similar_lines(rows):
    """Lines (document, text, number) that are similar to an earlier one, by comparing with all earlier lines."""
    lines = []
    for doc, text in rows:
        for k, line in enumerate((text or "").split("\n")):
            if spaced(line):
                lines.append((doc, text, k, frozenset(spaced(line))))
    gone = set()
    for n, (doc, text, k, words) in enumerate(lines):
        for _, _, _, other in lines[:n]:
            both = len(words & other)
            if 5 * both >= 4 * (len(words) + len(other) - both):
                gone.add((doc, text, k))
                break
    return gone


def without(text, doc, gone):
    if text is None:
        return None
    return "\n".join(line for k, line in enumerate(text.split("\n")) if (doc, text, k) not in gone)


def test_lines_against_all_pairs(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    gone = similar_lines(rows)
    found = {r.doc_id: r for r in op2_lines.op2_lines(spark, SMALL).collect()}
    assert len(found) == len(rows) and gone
    for doc, text in rows:
        assert found[doc].text == without(text, doc, gone)
        assert found[doc].n_chars == len(found[doc].text)


@pytest.mark.parametrize("piece, enough", [(8192, (2, 64)), (4, (1, 1)), (8, (1, 2))])
def test_lines_with_many_near_copies(spark, monkeypatch, piece, enough):
    """Small pieces and an early stop must not change the result."""
    monkeypatch.setattr(op2_lines, "PIECE", piece)
    monkeypatch.setattr(op2_lines, "ENOUGH", enough)
    rng = random.Random(3)
    words = [f"w{k}" for k in range(40)]
    base = [[rng.choice(words) for _ in range(rng.randint(1, 25))] for _ in range(6)]
    rows = []
    for doc in range(120):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, 3)):
                line[rng.randrange(len(line))] = rng.choice([*words, f"z{rng.random()}"])
            lines.append(" ".join(line))
        rows.append((doc, "\n".join(lines)))
    gone = similar_lines(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in op2_lines.dedup_lines(frame).collect()}
    assert {d: without(t, d, gone) for d, t in rows} == found


def test_lines_of_many_words(spark, monkeypatch):
    """Unrelated long lines that share rare words are told apart before their word sets are moved; near copies go."""
    rng = random.Random(11)
    vocabulary = [f"v{k}" for k in range(3000)]
    rows = [(doc, " ".join(rng.sample(vocabulary, 150))) for doc in range(300)]
    for doc in range(300, 360):  # sizes on both sides of what has the larger bitmap
        line = rows[doc - 300][1].split()[: rng.randint(55, 80)]
        near = line[: len(line) - rng.randint(0, 12)] + [f"z{rng.random()}" for _ in range(rng.randint(0, 8))]
        rows.append((doc, "\n".join([" ".join(line), " ".join(near)])))
    verified, moved = op2_lines._verified, []

    def counted(pairs, *others):
        moved.append(pairs.count())
        return verified(pairs, *others)

    monkeypatch.setattr(op2_lines, "_verified", counted)
    gone = similar_lines(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.text for r in op2_lines.dedup_lines(frame).collect()}
    assert {d: without(t, d, gone) for d, t in rows} == found and 10 < len(gone) < 60
    assert sum(moved) < 200


def test_hashes_of_short_and_long_spans():
    """A span's hash is the mixed sum of its mixed blocks, whichever way they are added up."""
    import numpy as np

    from llm import text

    full = (1 << 64) - 1
    mixed = lambda number: int(text.mix(np.array([number & full], np.uint64))[0])
    data = np.random.default_rng(5).integers(0, 256, 4000).astype(np.uint8)
    starts = np.arange(0, 3000, 29)
    ends = starts + np.arange(len(starts)) % 90 * 2
    for seed in (0, 3):
        for start, end, found in zip(starts, ends, text.span_hashes(data, starts, ends, seed)):
            blocks = [bytes(data[b : min(b + 8, end)]) for b in range(start, end, 8)]
            salts = [mixed(k * text._ODD + seed * text._ODD + 1) for k in range(len(blocks))]
            total = sum(mixed(int.from_bytes(b, "little") ^ salt) for b, salt in zip(blocks, salts))
            assert int(found) == mixed(total + int(end - start) * text._ODD)


def test_lines_odd_rows(odd):
    out = op2_lines.dedup_lines(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = [(r.doc_id, r.text) for r in out.collect()]
    # rows that agree in id and text stay alike, and the repeated line goes
    assert texts.count((1, "The cat sat.\n\nÄ b c")) == 2
    assert (2, None) in texts and (3, "") in texts and (4, "   \n\t ") in texts
    assert (6, "") in texts and (5, LONG) in texts
    assert op2_lines.dedup_lines(odd.limit(0)).count() == 0


def test_bpe_against_the_library(spark, docs, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(op3_bpe.default_vocabulary())
    rows = {r.doc_id: r for r in op3_bpe.op3_bpe(spark, SMALL).collect()}
    for doc in docs.collect():
        ids = library.encode(doc.text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        row = rows[doc.doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    coded = op3_bpe.decode(op3_bpe.encode(odd, "text", "ids"), "ids", "back").collect()
    for row in coded:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.back == library.decode(ids, skip_special_tokens=False)
    assert op3_bpe.encode(odd.limit(0), "text", "ids").count() == 0


def test_bpe_keeps_workers_small(spark, odd):
    """Decoding takes no second Python worker, and classes of characters are made in pieces."""
    coded = spark.createDataFrame([([0, 5, 0],), ([],), (None,)], "ids array<int>")
    back = op3_bpe.decode(coded, "ids", "back")
    assert "InArrow" not in back._jdf.queryExecution().executedPlan().toString()
    tokens = op3_bpe.Vocabulary.read(op3_bpe.default_vocabulary()).tokens
    assert [r.back for r in back.collect()] == [" ".join(tokens[[0, 5, 0]]), "", None]
    for wrong in (-1, len(tokens), None):
        with pytest.raises(Exception, match="not in the vocabulary"):
            op3_bpe.decode(spark.createDataFrame([([wrong],)], "ids array<int>"), "ids", "back").collect()
    op3_bpe.classes.cache_clear()
    tracemalloc.start()
    op3_bpe.classes()
    assert tracemalloc.get_traced_memory()[1] < 10 << 20
    tracemalloc.stop()


def test_bpe_random_characters():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(op3_bpe.default_vocabulary())
    rng = random.Random(5)
    letters = [chr(c) for c in [*range(1, 0x250), *range(0x600, 0x640)]]
    letters += list("ΣσςİẞΑ\u0085  ​　́Л中😀²½Ⅰ가가")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 200))) for _ in range(300)]
    texts += ["".join(rng.choice("'strevmld abc!\n<|>endoftxa") for _ in range(rng.randint(1, 60))) for _ in range(300)]
    texts += ["<|endoftext|><|startoftext|>a", "x" * 5000, "ab" * 5000]
    flat, begin = op3_bpe.Encoder(op3_bpe.default_vocabulary()).encode(texts)
    for k, text in enumerate(texts):
        assert flat[begin[k] : begin[k + 1]].tolist() == library.encode(text, add_special_tokens=False).ids


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def plain_contamination(text, items):
    words, hit, found = alnum(text), set(), set()
    for item, body in items:
        other = alnum(body)
        size = min(len(other), 10)
        wins = {tuple(other[k : k + size]) for k in range(len(other) - size + 1)} if other else set()
        for k in range(len(words) - size + 1):
            if size and tuple(words[k : k + size]) in wins:
                hit.update(range(k, k + size))
                found.add(item)
    return len(words), len(hit), found


@pytest.mark.parametrize("block, shard", [(8 << 20, 8 << 20), (60, 200)])
def test_contamination_odd_rows(spark, odd, monkeypatch, block, shard):
    """Also with a benchmark of many blocks and shards of one text."""
    monkeypatch.setattr(op5_decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(op5_decontaminate, "SHARD_BYTES", shard)
    items = [
        (1, "the cat sat"),
        (2, None),
        (3, "!!"),
        (10, "on the mat"),
        (11, "Again AND again, it did so on the mat"),
        (12, " ".join(LONG.split()[100:125])),
        (10, "under the same id"),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = op5_decontaminate.contamination(odd, bench).collect()
    assert len(rows) == len(ODD)
    expected = []
    for doc, text in ODD:
        n, hit, found = plain_contamination(text, items)
        ids = ",".join(sorted(map(str, found)))
        expected.append((doc, n, hit, len(found), hashlib.sha256(ids.encode()).hexdigest(), hit > 0))
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, expected))
    cut = op5_decontaminate.remove_passages(odd, bench)
    assert cut.columns == odd.columns
    again = op5_decontaminate.contamination(cut.where("doc_id in (5, 6)"), bench).collect()
    assert all(r.n_hit == 0 for r in again)
    assert all(r.n_chars == len(r.text or "") for r in cut.collect())
    assert op5_decontaminate.contamination(odd.limit(0), bench).count() == 0
    assert all(not r.contaminated for r in op5_decontaminate.contamination(odd, bench.limit(0)).collect())


def plain_fingerprint(text):
    words = spaced(text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints):
    """Smallest id reachable, by comparing all pairs of (id, print)."""
    group = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(prints):
            for j, (_, b) in enumerate(prints[:i]):
                if (a ^ b).bit_count() <= 3 and group[i] != group[j]:
                    group[i] = group[j] = min(group[i], group[j])
                    changed = True
    least = {}
    for (ident, _), g in zip(prints, group):
        if ident is not None:
            least[g] = min(ident, least.get(g, ident))
    return [(ident, least.get(g)) for (ident, _), g in zip(prints, group)]


def test_simhash_against_all_pairs(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    prints = [(d, plain_fingerprint(t)) for d, t in rows]
    found = {r.doc_id: r for r in op6_simhash.op6_simhash(spark, SMALL).collect()}
    assert {d: f"{p:016x}" for d, p in prints} == {d: r.fingerprint for d, r in found.items()}
    assert dict(plain_groups(prints)) == {d: r.component_id for d, r in found.items()}


@pytest.mark.parametrize("block", [4096, 8])
def test_bit_slices_find_all_links(spark, monkeypatch, block):
    """Clusters of prints that share bands, with blocks so small that buckets are cut into cells."""
    monkeypatch.setattr(op6_simhash, "BLOCK", block)
    rng = random.Random(1)
    prints = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(25):
            p = centre
            for _ in range(rng.randint(0, 5)):
                p ^= 1 << rng.randrange(64)
            prints.append(p)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    edges = op6_simhash.fingerprint_links(spark.createDataFrame(signed, "p long"), "p").collect()
    at = {s[0]: k for k, s in enumerate(signed)}
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for e in edges:
        assert (prints[at[e.a]] ^ prints[at[e.b]]).bit_count() <= 3
        parent[max(find(at[e.a]), find(at[e.b]))] = min(find(at[e.a]), find(at[e.b]))
    assert [find(k) for k in range(len(prints))] == [g for _, g in plain_groups(list(enumerate(prints)))]


def test_simhash_odd_rows(odd):
    out = op6_simhash.near_duplicates(odd)
    assert out.columns == [c for c in odd.columns if c != "fingerprint"] + ["fingerprint", "component_id"]
    rows = out.collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.fingerprint == f"{plain_fingerprint(r.text):016x}"
    expected = plain_groups([(i, plain_fingerprint(t)) for i, t in ODD])
    assert sorted(map(str, ((r.doc_id, r.component_id) for r in rows))) == sorted(map(str, expected))
    kept = op6_simhash.keep_first(odd)
    assert kept.columns == odd.columns
    assert kept.where("fingerprint = 'f'").count() == kept.count()
    assert op6_simhash.near_duplicates(odd.limit(0)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    from llm.components import connected_components

    edges = [(k, k + 1) for k in range(60)] + [(200, k) for k in range(100, 199)] + [(5, 5), (None, 3), (7, 6)]
    found = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {k: 100 for k in [*range(100, 199), 200]}


def plain_chunks(data):
    """Chunk spans by a loop over the bytes: the shift pushes bytes older than the window out of 32 bits."""
    gear, h, last, out = op10_substrings.GEAR.tolist(), 0, 0, []
    for at, byte in enumerate(data, 1):
        h = ((h << 2) + gear[byte]) % 2**32
        if at - last == 256 or (at - last >= 16 and h < 2**27):
            out.append((last, at))
            last = at
    return out + [(last, len(data))] * (last < len(data))


def plain_repeats(rows):
    """Texts without their repeats, from the bytes alone: first occurrences in a dictionary, growth byte by byte."""
    first, whole, out = {}, set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        spans = plain_chunks(data)
        hit = []
        for low, high in spans:
            source = first.setdefault(data[low:high], (data, low))
            hit.append(None if source == (data, low) and source[0] is data else source)
        if data in whole:
            out[doc] = ""
            continue
        whole.add(data)
        gone = bytearray(len(data))
        for k, (low, high) in enumerate(spans):
            if hit[k] is None:
                continue
            gone[low:high] = b"1" * (high - low)
            source, at = hit[k]
            for far in range(1, 513):
                if (k and hit[k - 1]) or far > min(low, at) or data[low - far] != source[at - far]:
                    break
                gone[low - far] = 49
            at += high - low
            for far in range(512):
                if (k + 1 < len(spans) and hit[k + 1]) or high + far >= len(data) or at + far >= len(source):
                    break
                if data[high + far] != source[at + far]:
                    break
                gone[high + far] = 49
        kept, at = b"", 0
        for run in re.finditer(rb"1+", bytes(gone)):
            low, high = run.span()
            while 0 < low < high and not data[low - 1 : low].isspace() and not data[low : low + 1].isspace():
                low += 1
            while low < high < len(data) and not data[high - 1 : high].isspace() and not data[high : high + 1].isspace():
                high -= 1
            if 0 < low < high < len(data) and not data[low - 1 : low].isspace() and not data[high : high + 1].isspace():
                if data[high - 1 : high].isspace():
                    high -= 1
                elif data[low : low + 1].isspace():
                    low += 1
            if len(data[low:high].split()) >= 16:
                kept, at = kept + data[at:low], high
        out[doc] = None if text is None else (kept + data[at:]).decode()
    return out


def test_substrings_against_a_scan(spark, docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    frame = spark.createDataFrame(docs.select("doc_id", "text").rdd, "doc_id long, text string").repartition(5)
    for found in (op10_substrings.op10_substrings(spark, SMALL), op10_substrings.dedup_substrings(frame, removed="n_removed")):
        found = found.collect()
        assert plain_repeats(rows) == {r.doc_id: r.text for r in found}
        assert any(r.n_removed for r in found)


def test_copies_of_short_texts_and_passages_without_spaces_go(spark):
    rng = random.Random(5)
    signs = lambda n: "".join(chr(rng.randint(0x4E00, 0x9000)) for _ in range(n))
    passage = signs(120)
    texts = ["one two", "one two", "two", signs(80) + passage, signs(60) + passage + signs(70), "the tail", "x " * 30 + "the tail"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in op10_substrings.dedup_substrings(frame).collect()}
    assert out[1] == "" and out[4] == texts[4].replace(passage, "")
    assert all(out[k] == texts[k] for k in (0, 2, 3, 5, 6))


def test_passages_go_to_the_byte(spark):
    """Passages of 51 words and more in texts of words that are all different: nothing of them stays, nothing else goes."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 9)))
    fresh = lambda n: [word() for _ in range(n)]
    texts, expected = [], []
    for _ in range(150):
        passage, a, b, c, d = (fresh(n) for n in (rng.randint(51, 60), 40, 40, rng.randint(0, 40), rng.randint(0, 40)))
        for before, after in ((a, b), (c, d)):
            texts.append(" ".join([*before, *passage, *after]))
        expected.append((a + passage + b, c + d))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.text.split() for r in op10_substrings.dedup_substrings(frame).collect()}
    assert all(out[2 * k] == kept for k, (kept, _) in enumerate(expected))
    exact = sum(out[2 * k + 1] == rest for k, (_, rest) in enumerate(expected))
    assert exact >= 148, exact


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    texts = [" ".join(word() for _ in range(200)) for _ in range(60)]
    passages = [" ".join(texts[k].split()[20 : 20 + rng.randint(51, 90)]) for k in range(20)]
    for k, passage in enumerate(passages):
        head = " ".join(word() for _ in range(rng.randint(0, 30)))
        texts.append(f"{head} {passage} {texts[40 + k][:37]}")
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r for r in op10_substrings.dedup_substrings(frame, removed="gone").collect()}
    assert all(out[k].text == texts[k] and out[k].gone == 0 for k in range(60))
    assert all(out[60 + k].gone > 0 and p not in out[60 + k].text for k, p in enumerate(passages))


def test_substrings_odd_rows(odd):
    out = op10_substrings.dedup_substrings(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    texts = [(r.doc_id, r.text) for r in out.collect()]
    assert texts.count(ODD[0]) == 2 and (2, None) in texts and (3, "") in texts
    assert len([t for d, t in texts if d == 6][0]) < 100
    assert op10_substrings.dedup_substrings(odd.limit(0)).count() == 0


PAGES = [
    (1, "u", "<html><body><nav><a href=x>Menu</a></nav><article><h1>A &amp; B</h1><p>One  two<br>three<p>four</article><footer>foot</footer>"),
    (2, "u", None),
    (3, "u", ""),
    (4, None, "plain words without any markup at all, but rather many of them"),
    (
        5,
        "u",
        "<body><header><h1>Site</h1></header><div id=cookie-notice>We use cookies</div><div><h2>Title here</h2>"
        "<p>A paragraph of the story with quite a few words in it, and <a href=y>a link</a> too.</p><div class='advert'>Buy now</div>"
        "<p>A second paragraph that also has some words.</p></div><aside>More</aside><section id=comments><p>Nice text, I liked it"
        "</p></section><form><p>Search for it here</p></form><script>if (a<b) {'</p>'}</script></body>",
    ),
    (6, "u", "<p>" + "word " * 50_000),
    (6, "u", "<p>" + "word " * 50_000),
    (None, "u", "<nav>only a menu</nav>"),
]


def test_main_text(spark):
    frame = spark.createDataFrame([(*p, 1) for p in PAGES], "page_id long, url string, html string, text int")
    out = op1_html.add_main_text(frame, "html", "body")
    assert out.columns == [*frame.columns, "body"]
    rows = [(r.page_id, r.body) for r in out.collect()]
    assert (1, "A & B\n\nOne two three\n\nfour") in rows
    assert (2, "") in rows and (3, "") in rows and (None, "") in rows
    assert (4, PAGES[3][2]) in rows
    assert rows.count((6, " ".join(["word"] * 50_000))) == 2
    story = dict(r for r in rows if r[0] == 5)[5]
    assert story == (
        "Title here\n\nA paragraph of the story with quite a few words in it, and a link too."
        "\n\nA second paragraph that also has some words."
    )
    assert op1_html.add_main_text(frame.limit(0), "html", "body").count() == 0


def test_all_pages_give_their_article(spark):
    import html

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    for row in op1_html.op1_html(spark, SMALL).collect():
        body = pages[row.page_id].split("<article>")[1].split("</article>")[0].split("<footer>")[0]
        if "</article>" not in pages[row.page_id]:
            continue
        blocks = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
        texts = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
        assert row.text == "\n\n".join(t for t in texts if t) and row.n_chars == len(row.text)


@pytest.fixture(scope="module")
def page_weights(spark):
    counts: Counter = Counter()
    for row in spark.read.parquet(f"{SMALL}/pages.parquet").collect():
        counts.update(op1_html.count_features(op1_html.read(row.html)))
    return op1_html.Weights.fit(counts)


STORY = ["Part %d " % k + " ".join(f"word{j}" for j in range(60)) for k in range(3)]


def test_story_in_a_div_beside_teaser_articles(page_weights):
    teasers = "".join(f"<article><h3><a href=x{k}>Read this too</a></h3></article>" for k in range(4))
    page = f"<body>{teasers}<div>{''.join(f'<p>{s}</p>' for s in STORY)}</div>{teasers}</body>"
    text = op1_html.main_text(page, page_weights)
    assert all(s in text for s in STORY)
    page = f"<body><div>{' '.join(STORY)}</div>{teasers}</body>"
    assert " ".join(STORY) in op1_html.main_text(page, page_weights)


def test_story_in_several_articles(page_weights):
    page = "<div>Some short words here</div>".join(f"<article><p>{s}</p></article>" for s in STORY)
    text = op1_html.main_text(f"<body>{page}</body>", page_weights)
    assert text.split("\n\n") == STORY


def test_elements_closed_in_themselves_hide_nothing(page_weights):
    icon, formula = '<svg class="icon" viewBox="0 0 1/1"/>', "<math display=block />"
    page = f"<body><article><h1>{icon}Head</h1><p>{STORY[0]}</p>{formula}<p>{STORY[1]}<svg><path d='M/'/>no</svg></p></article></body>"
    text = op1_html.main_text(page, page_weights)
    assert STORY[0] in text and STORY[1] in text and "no" not in text.split()


@pytest.mark.parametrize("length", [1024, 4096])
def test_words_that_collided_by_construction(spark, length):
    """The two words of the Thue-Morse pattern agree under any polynomial hash modulo 2**64."""
    from tokenizers import Tokenizer

    a, b = "a", "b"
    while len(a) < length:
        a, b = a + b, b + a
    frame = spark.createDataFrame([(1, a), (2, b), (3, f"{b} {a}")], "doc_id long, text string").coalesce(1)
    library = Tokenizer.from_file(op3_bpe.default_vocabulary())
    for row in op3_bpe.encode(frame, "text", "ids").collect():
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids
    item = spark.createDataFrame([(7, a)], "item_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_hit) for r in op5_decontaminate.contamination(frame, item).collect()}
    assert found == {1: (1, 1), 2: (1, 0), 3: (2, 1)}
    assert {r.doc_id: r.text for r in op2_lines.dedup_lines(frame).collect()} == {1: a, 2: b, 3: f"{b} {a}"}


def test_crc_parts(spark):
    from llm.frames import crc_part

    rows = spark.range(50).select("id", crc_part(F.col("id"), 10).alias("p")).collect()
    assert all(r.p == zlib.crc32(str(r.id).encode()) % 10 for r in rows)
