"""Collocations, cross-tokenizer alignment and top-k search against brute-force versions."""

import hashlib
import itertools
import math
import random
import re
import string
from collections import Counter, defaultdict
from xml.etree import ElementTree

import numpy as np
import public_tokenizers
import pytest

from folioflow.llm import collocations, cover_trees, licences, main_text, token_alignment

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
DOCS = "doc_id bigint, text string, lang string, gram string, f bigint, block bigint, a int, words string"


def documents(spark, rows):
    """rows: (doc_id, text, lang); the other columns have names that the operators use."""
    return spark.createDataFrame([(*r, "g", 1, 2, 3, "w") for r in rows], DOCS)


# ---- 12

def brute_phrases(docs, least, share, limit):
    count, total = defaultdict(Counter), Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 5):
                count[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in count.items():
        some = {g: n for g, n in f.items() if n >= least and len(g) > 1}
        gone = {g[i:i + m] for g, n in some.items() for m in (2, 3) if m < len(g) for i in range(len(g) - m + 1)
                if g[i:i + m] in some and 100 * n >= share * some[g[i:i + m]]}
        rows = []
        for g, a in some.items():
            if g not in gone:
                score, k = min((2000000 * a // (f[g[:k]] + f[g[k:]]), k) for k in range(1, len(g)))
                rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        out += [(lang, i + 1, g.decode(), -a, l, r, total[lang], -s) for i, (s, a, g, l, r) in enumerate(sorted(rows)[:limit])]
    return Counter(out)


@pytest.fixture(scope="module")
def prose():
    """Random prose with phrases, a long repeated passage, ties, odd separators, nulls, empties, repeated rows, one very long text."""
    r = random.Random(5)
    vocab = ["".join(r.choices("abcdéß", k=r.randint(1, 4))) for _ in range(40)] + ["Ab", "aB", " ", "x y"]
    passage = " ".join(f"p{i}" for i in range(37))
    some = lambda n: "".join(r.choice(vocab) + r.choice([" "] * 12 + ["\t", "  ", ". ", ",", "\n", "\r\n", "\x0b", "? "]) for _ in range(n))
    out = [(1, None, "en"), (2, "", "en"), (3, " .,\n", "en"), (4, "one", None), (5, "a a a a a a a a", "en"), (5, "a a a a a a a a", "en"), (None, "New York. new york", "fr")]
    for i in range(60):
        out.append((10 + i, some(r.randint(1, 60)) + (f" {passage} " if i % 2 else "") + "q r s. q r t, q r s u", r.choice(["en", "en", "de", None, "und"])))
    return out + [(900, some(20_000), "de"), (901, passage, "en"), (902, "p0 p1 p2", "en")]


@pytest.mark.parametrize("least,share,limit", [(5, 80, 1000), (30, 80, 7), (3, 100, 2000)])
def test_phrases(spark, prose, least, share, limit):
    graph = collocations.Graph(documents(spark, prose), least=least)
    assert Counter(tuple(x) for x in graph.top(limit, share).collect()) == brute_phrases(prose, least, share, limit)


def test_paths(spark, prose):
    graph = collocations.Graph(documents(spark, prose), least=5)
    found = {(x.lang, x.path): x.f for x in graph.paths().collect()}
    pieces = [((lang or "und"), re.findall("[^\x20\x09]+", p)) for _, t, lang in prose for p in re.split("[.,;:!?\x0a-\x0d]", (t or "").translate(LOWER))]
    # p0 p1 p2 also stands where nothing follows, so the path begins one word later.
    assert any(p == " ".join(f"p{i}" for i in range(1, 37)) for lang, p in found if lang == "en")
    for (lang, path), f in found.items():
        words = path.split(" ")
        assert sum(w[i:i + len(words)] == words for x, w in pieces if x == lang for i in range(len(w))) == f
    assert collocations.Graph(documents(spark, [])).top().count() == 0
    assert collocations.Graph(documents(spark, prose[:4])).top().count() == 0


def test_counts_by_flow(spark, prose):
    """All counts that the edges and ends give, frequent or not."""
    want = Counter()
    for _, text, lang in prose:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            for k in range(1, 5):
                want.update(("und" if lang is None else lang, " ".join(w[i:i + k])) for i in range(len(w) - k + 1))
    graph = collocations.Graph(documents(spark, prose), least=1)
    assert {(x.lang, x.gram): x.f for x in graph.phrases.collect()} == dict(want)
    total = Counter()
    for (lang, gram), n in want.items():
        total[lang] += n * (" " not in gram)
    assert {x.lang: x.n for x in graph.totals().collect()} == dict(total)


# ---- 13

@pytest.fixture(scope="module")
def strange():
    r = random.Random(6)
    vocab = ["The", "the", "été", "straße", "naïve", "don't", "x1", "12345", "…", "日本語", "😀", "é", "<|endoftext|>", "</s>", "<0x41>", "“q”", "fi", "İ"]
    some = lambda n: "".join(r.choice(vocab) + r.choice([" ", " ", " ", "  ", "\n", "\t", ".", ", ", " ", "　"]) for _ in range(n))
    out = [(1, None, "en"), (2, "", "en"), (3, " ", "en"), (4, "a▁b", "en"), (5, "\x00", None), (6, "one", "en"), (6, "one", "en"), (None, "No id.", "en")]
    out += [(10 + i, some(r.randint(1, 80)), "en") for i in range(60)]
    return out + [(900, some(4000), "en"), (901, "a" * 3000, "en"), (902, " \n" * 500, "en")]


def brute_alignment(docs):
    """Each document's tokens by the libraries themselves, every pair of byte ranges tried."""
    from tokenizers import Tokenizer
    import sentencepiece

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    s = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}

    def spans(parts):
        ends = list(itertools.accumulate(map(len, parts)))
        return list(zip([0, *ends], ends))

    made, count = [], Counter()
    for doc, text, _ in docs:
        a = t.encode(" " + (text or ""), add_special_tokens=False).ids
        b = s.encode(text or "")
        pa = [bytes(of[c] for c in t.id_to_token(i)) for i in a]
        pb = [bytes([int(s.id_to_piece(i)[3:5], 16)]) if s.is_byte(i) else s.id_to_piece(i).replace("▁", " ").encode() for i in b]
        raw = (" " + (text or "")).encode()
        if not text or b"".join(pa) != raw or b"".join(pb) != raw:
            made.append((doc, 0, 0, [], ""))
            continue
        sa, sb = spans(pa), spans(pb)
        links, at = [], 0
        for i, (x, y) in enumerate(sa):
            while sb[at][1] <= x:
                at += 1
            links += [(a[i], b[j]) for j in itertools.takewhile(lambda j: j < len(sb) and sb[j][0] < y, itertools.count(at))]
        groups = []
        ends = sorted({y for _, y in sa} & {y for _, y in sb})
        for lo, hi in zip([0, *ends], ends):
            groups.append(",".join(str(a[i]) for i, (x, y) in enumerate(sa) if lo <= x and y <= hi) + "|" + ",".join(str(b[i]) for i, (x, y) in enumerate(sb) if lo <= x and y <= hi)) if len(raw) < 5000 else groups.append(None)
        count.update(links)
        made.append((doc, len(a), len(b), links, groups))
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    return Counter((doc, na, nb, len(groups), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    "" if not groups else None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest()) for doc, na, nb, links, groups in made), count


@pytest.mark.parametrize("block", [4 << 20, 2000])
def test_alignment(spark, strange, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    found = token_alignment.Alignment(documents(spark, strange).repartition(3))
    want, count = brute_alignment(strange)
    long = {900, 902}
    got = Counter((x.doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, None if x.doc_id in long else x.groups_sha256) for x in found.documents().collect())
    assert got == Counter({(*k[:-1], None if k[0] in long else k[-1]): n for k, n in want.items()})
    assert {(x.a, x.b): x["count"] for x in found.pairs.collect()} == dict(count)


def test_alignment_groups(spark, strange):
    got = defaultdict(list)
    docs = [x for x in strange if x[0] is not None]
    for x in token_alignment.Alignment(documents(spark, docs).dropDuplicates(["doc_id"])).groups().collect():
        got[x.doc_id].append(x)
    a, b = token_alignment.tokenizer(token_alignment.A), token_alignment.tokenizer(token_alignment.B)
    for doc, text, _ in docs:
        raw, rows = (" " + (text or "")).encode(), sorted(got[doc], key=lambda x: x.start)
        assert [x.start for x in rows] == [0, *(x.end for x in rows[:-1])][:len(rows)]
        assert (rows[-1].end == len(raw)) if rows else doc in (1, 2, 4)
        for x in rows:
            assert raw[x.start:x.end] == b"".join(a.bytes[i].as_py() for i in x.a_ids) == b"".join(b.bytes[i].as_py() for i in x.b_ids)
    assert token_alignment.Alignment(documents(spark, [])).documents().count() == 0


# ---- 11

def brute_top(rows, k):
    good = [(i, [int(np.floor(1024 * float(np.float32(c)))) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
    out = Counter()
    for q, a in good:
        if q % 100 == 0:
            found = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q)[:k]
            out.update((q, r + 1, i, -s) for r, (s, i) in enumerate(found))
    return out


def vectors(r, n, d, kind):
    if kind == "clusters":
        centres = r.normal(size=(6, d)) * 3
        return centres[r.integers(0, 6, n)] + r.normal(size=(n, d)) * 0.05
    if kind == "copies":
        return np.where(r.random((n, 1)) < 0.4, np.ones((1, d)) / 8, np.round(r.normal(size=(n, d))))
    return r.normal(size=(n, d)) * (1e5 if kind == "large" else 0.2)


@pytest.mark.parametrize("kind", ["plain", "clusters", "copies", "large"])
def test_top_k(spark, monkeypatch, kind):
    monkeypatch.setattr(cover_trees, "LEAST_ROWS", 100)
    monkeypatch.setattr(cover_trees, "STRIDE", 50)
    r = np.random.default_rng(8)
    rows = [(i - 200, v.tolist()) for i, v in enumerate(vectors(r, 900, 12, kind))]
    rows += [(2000, None), (2100, [1.0, None]), (2200, [float("nan")]), (2300, [float("inf"), 1.0]), (2400, []), (2500, [0.5, -0.5]), (None, [1.0] * 12), (3000, [-0.0] * 12)]
    r.shuffle(rows)
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id bigint, embedding array<float>, row int, block int").repartition(3)
    got = Counter(tuple(x) for x in cover_trees.top_k(table).collect())
    assert got == brute_top(rows, 10)


def test_top_k_edges(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert cover_trees.top_k(spark.createDataFrame([], schema)).count() == 0
    few = [(0, [1.0, 2.0]), (1, [1.0, 1.0]), (100, [0.0, 1.0])]
    assert Counter(tuple(x) for x in cover_trees.top_k(spark.createDataFrame(few, schema)).collect()) == brute_top(few, 10)
    twice = [(0, [1.0]), (0, [1.0]), (7, [2.0]), (7, [2.0])]
    got = Counter(tuple(x) for x in cover_trees.top_k(spark.createDataFrame(twice, schema)).collect())
    assert got == Counter({(0, 1, 7, 2 << 20): 2, (0, 2, 7, 2 << 20): 2})
    huge = [(0, [3e38]), (1, [3e38]), (2, [-3e38])]
    got = sorted(tuple(x) for x in cover_trees.top_k(spark.createDataFrame(huge, schema)).collect())
    assert got == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -2**63)]


def test_pruning():
    """On clustered vectors most node pairs are never compared; no bound is passed."""
    r = np.random.default_rng(9)
    points = np.floor(vectors(r, 3000, 16, "clusters") * 1024).astype(np.int64)
    parts = list(cover_trees.leaves(points, 64))
    assert sorted(np.concatenate([p for p, _ in parts])) == list(range(3000)) and max(len(p) for p, _ in parts) <= 64
    order = np.concatenate([p for p, _ in parts])
    block = cover_trees.Block(order, order, points[order], np.concatenate(([0], np.cumsum([len(p) for p, _ in parts]))), np.array([x for _, x in parts]))
    for p, radius in list(cover_trees.leaves(points[:200], 32))[:4]:
        reach = cover_trees.bounds(points[p[0]], radius, block.centres, block.norm, block.radius)
        exact = cover_trees.products(points[p], block.vectors).max(axis=0)
        assert all(exact[a:b].max() <= x for a, b, x in zip(block.first[:-1], block.first[1:], reach))
        kth = cover_trees.search(block, p, points[p], radius, np.full(len(p), cover_trees.NONE), 10)[1]
        assert (reach < kth.min()).mean() > 0.5


# ---- 8

def test_unknown_licence_files_end_inheritance(spark):
    files = [("LICENSE", "Released under the MIT License."), ("a.c", "code"), ("vendor/x/LICENSE", "All rights reserved. Unauthorized copying is strictly prohibited."),
             ("vendor/x/a.c", "code"), ("vendor/x/deep/b.c", None), ("vendor/x/mit/LICENSE", "Released under the MIT License."), ("vendor/x/mit/c.c", ""), ("vendor/y/COPYING", None),
             ("vendor/y/d.c", "x"), ("vendor/z/NOTICE", "Made by someone."), ("vendor/z/e.c", "x"), ("vendor/x/own.c", "// Released under the MIT License."),
             ("vendor/w/LICENSE", "Keep out."), ("vendor/w/LICENSE.mit", "Released under the MIT License."), ("vendor/w/f.c", "x"),
             ("s1.c", "// SPDX-License-Identifier: MIT OR Apache-2.0"), ("s2.c", "/* SPDX-License-Identifier: (MIT OR  GPL-2.0-or-later) AND BSD-3-Clause */"),
             ("vendor/x/s3.c", "# SPDX-License-Identifier: MIT OR Nobody-1.0")]
    got = {x.path: (x.licence, x.origin) for x in licences.scan(spark.createDataFrame(files, "path string, text string")).collect()}
    unknown, mit, inherited = (None, "unknown"), ("MIT", "own"), ("MIT", "inherited")
    assert {k: v for k, v in got.items() if k != "vendor/x/s3.c"} == {
        "LICENSE": mit, "a.c": inherited, "vendor/x/LICENSE": unknown, "vendor/x/a.c": unknown, "vendor/x/deep/b.c": unknown, "vendor/x/mit/LICENSE": mit,
        "vendor/x/mit/c.c": inherited, "vendor/y/COPYING": unknown, "vendor/y/d.c": unknown, "vendor/z/NOTICE": inherited, "vendor/z/e.c": inherited, "vendor/x/own.c": mit,
        "vendor/w/LICENSE": inherited, "vendor/w/LICENSE.mit": mit, "vendor/w/f.c": inherited, "s1.c": ("MIT OR Apache-2.0", "own"),
        "s2.c": ("(MIT OR GPL-2.0-or-later) AND BSD-3-Clause", "own")}
    assert got["vendor/x/s3.c"][0] != "MIT OR Nobody-1.0"


# ---- 3

def test_names_do_not_cost_a_page():
    text = " ".join(["Words of an article that goes on for a while."] * 12)
    body = "".join(f"<p>{text} {i}</p>" for i in range(5))
    want = " ".join(f"{text} {i}" for i in range(5))
    links = "".join(f'<a href="/{i}">Other page {i}</a>' for i in range(30))
    assert main_text.extract(f'<body><div class="layout has-sidebar">{body}</div></body>') == want
    assert main_text.extract(f'<body><div class="page-with-sidebar"><article>{body}</article><div class="sidebar">{links}</div></div></body>') == want
    assert main_text.extract(f'<body><div id="no-header"><main>{body}</main></div></body>') == want
    price = body.replace("<p>", '<p class="share-price">', 1)
    assert main_text.extract(f"<body><div>{price}</div></body>") == want
    assert main_text.extract(f'<body><div class="site-header">{text}</div><div>{body}</div><div class="cookie-banner">{text}</div><div class="user-comments">{body * 3}</div></body>') == want


def brute_density(html):
    """Densities and density sums of every element of a well-formed page, by definition."""
    root = ElementTree.fromstring(html)
    chars = lambda e: sum(len("".join(t.split())) for t in e.itertext())
    linked = lambda e: chars(e) if e.tag == "a" else sum(map(linked, e))
    share = linked(root) / max(1, chars(root))

    def density(e):
        c, t, lc, lt = chars(e), len(list(e.iter())) - 1, linked(e), sum(x.tag == "a" for x in e.iter()) - (e.tag == "a")
        if not c:
            return 0.0
        base = math.log(c / max(1, c - lc) * max(1, lc) + share * c + math.e)
        return c / max(1, t) * math.log(c / max(1, lc) * max(1, t) / max(1, lt) + 1, base)

    return [(e.tag, density(e), sum(density(x) for x in e)) for e in root.iter()]


def test_density_by_definition():
    r = random.Random(12)

    def some(depth):
        if depth == 0:
            return " ".join("word" for _ in range(r.randint(0, 30)))
        return "".join(r.choice(["<div>{}</div>", "<section>{}</section>", "<p>{}</p>", '<a href="x">{}</a>', "<b>{}</b>", "{}"]).format(some(depth - 1 if r.random() < 0.8 else 0)) for _ in range(r.randint(1, 4)))

    for _ in range(40):
        # No block stands inside a paragraph, which would close it.
        page = re.sub("(<p>)((?:(?!</?p>).)*(?:<div>|<section>|<p>).*)", "<i>\\2", f"<html><div>{some(4)}</div></html>")
        try:
            want = brute_density(page)
        except ElementTree.ParseError:
            continue
        tree = main_text.Tree()
        tree.feed(page)
        tree.close()
        nodes = main_text._in_order(tree.root)
        main_text._measure(nodes)
        if [n.tag for n in nodes] == [t for t, _, _ in want]:
            for node, (_, density, total) in zip(nodes, want):
                assert math.isclose(node.density, density, rel_tol=1e-9) and math.isclose(node.total, total, rel_tol=1e-9, abs_tol=1e-9)
