"""Every operator against a brute-force version or an exact property, on small tables with all awkward cases."""

import hashlib
import itertools
import random
import re
import string
import textwrap
import zlib
from collections import Counter
from math import log10
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from folioflow.llm import (byte_pairs, class_ngrams, decontaminate, licences, main_text, near_duplicates, pseudonyms, quality_rules,
                           token_rollups, toxicity)
from folioflow.llm.common import in_batches, words

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
# Columns whose names operators use inside must not disturb them.
DOCS = "doc_id bigint, text string, lang string, source string, key string, node string, w string, row string, gone string, n_chars bigint"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(*r, *("en", "src")[len(r) - 2:], "k", "n", "w", "r", "g", 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


def spaced(text, lower=False):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


@pytest.fixture(scope="module")
def texts():
    """Nulls, empties, ties, copies, near copies, a chain, one long text, repeated rows."""
    r = random.Random(1)
    vocab = ["".join(r.choices("abcdeéß", k=r.randint(1, 5))) for _ in range(300)]
    some = lambda n: [r.choice(vocab) for _ in range(n)]
    out = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "One"), (6, "two words"), (7, "a b c d"), (8, "A B c D")]
    for k in range(25):
        base = some(r.randint(20, 120))
        for j in range(r.choice([1, 1, 2, 5])):
            w = list(base)
            for _ in range(r.choice([0, 1, 2, 3])):
                w[r.randrange(len(w))] = r.choice(vocab)
            out.append((100 + 10 * k + j, " ".join(w) + ("\n" + " ".join(w[:5])) * r.choice([0, 2])))
    chain = some(150)
    for j in range(8):
        chain[j * 6:j * 6 + 2] = some(2)
        out.append((900 + j, " ".join(chain)))
    out.append((950, " ".join(some(20_000))))
    out += [(101, out[9][1]), (4, "one"), (None, "a b c d"), (None, None)]
    return out


# ---- 2

def brute_contamination(docs, items, span=13):
    windows = {}
    for item, text in items:
        w = alnum(text)
        n = min(len(w), span)
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault((n, tuple(w[i:i + n])), set()).add("" if item is None else str(item))
    lengths = {n for n, _ in windows}
    out = []
    for doc, text in docs:
        w, hit, found = alnum(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                if (n, tuple(w[i:i + n])) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[n, tuple(w[i:i + n])]
        out.append((doc, len(w), len(hit), len(found), ",".join(sorted(found))))
    return Counter(out)


def test_contamination(spark, texts):
    r = random.Random(3)
    passage = alnum(texts[12][1])
    items = [(1, " ".join(passage[:13])), (10, "x " + " ".join(passage[3:30])), (2, None), (3, ""), (None, "two words"), (4, "ONE"), (4, " ".join(passage[:13])),
             (5, " ".join(alnum(texts[-5][1])[7:300])), (6, " ".join(passage[:12]) + " nowhere else"), (7, "a a a a a a a a a a a a a a a")]
    docs = texts + [(2000 + i, " ".join(r.choices(["a", "b"], k=40)) + " " + "a " * r.randint(1, 30)) for i in range(5)]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.contaminated(documents(spark, docs), bench)
    got = Counter((x.doc_id, x.n_words, x.n_hit, x.n_items, ",".join(x["items"])) for x in found.collect())
    assert got == brute_contamination(docs, items)
    kept = Counter(x.doc_id for x in decontaminate.keep_clean(documents(spark, docs), bench).collect())
    assert kept == Counter(k[0] for k in brute_contamination(docs, items).elements() if not (k[2] > 0 and 20 * k[2] >= k[1]))
    assert decontaminate.contaminated(documents(spark, docs[:9]), bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.contaminated(documents(spark, []), bench).count() == 0


# ---- 6

def test_quality(spark, texts):
    docs = texts + [(3000, "a b c a b c d"), (3001, "a a a a a"), (3002, "x\ny\nx\n\n \n\nx"), (3003, "# a |b| 5% <x> $&*")]
    got = Counter()
    for x in quality_rules.judge(documents(spark, docs), ["doc_id"]).collect():
        got[x.doc_id, x.n_words, x.word_chars, x.n_symbols, x.n_dup_lines, x.n_repeat_words, x.base_failed] += 1
    want = Counter()
    for doc, text in docs:
        w = spaced(text)
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        rep = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in range(i, i + 3)}
        lines = [x for x in (text or "").split("\n") if spaced(x)]
        want[doc, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(rep),
             len(w) < 50 or 100 * len(rep) > 50 * len(w)] += 1
    assert got == want
    good = quality_rules.keep_good(documents(spark, docs))
    assert good.schema.fieldNames() == documents(spark, []).schema.fieldNames()
    assert quality_rules.keep_good(documents(spark, [])).count() == 0


# ---- 7

def brute_components(docs, width, percent=80):
    sets = []
    for _, text in docs:
        w = spaced(text, lower=True)
        sets.append({tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    lead = list(range(len(docs)))

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    for i, j in itertools.combinations(range(len(docs)), 2):
        a, b = sets[i], sets[j]
        if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
            lead[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return Counter((doc, len(sets[i]), None if doc is None else least[top(i)]) for i, (doc, _) in enumerate(docs))


def test_near_duplicates(spark, texts):
    got = near_duplicates.near_duplicates(documents(spark, texts), width=4).collect()
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got) == brute_components(texts, 4)
    assert all(x.kept == (x.doc_id == x.component_id) for x in got)
    kept = near_duplicates.keep_first(documents(spark, texts))
    assert kept.columns == documents(spark, []).columns
    ids = Counter(x.doc_id for x in kept.collect())
    want = {d for d, _, c in brute_components(texts, 5) if d == c and d is not None}
    assert set(ids) - {None} == want and ids[None] == 2 and all(n == 1 for d, n in ids.items() if d is not None)
    assert near_duplicates.near_duplicates(documents(spark, [])).count() == 0


def test_a_large_group_of_near_copies_is_one_component(spark):
    r = random.Random(9)
    base = [f"w{r.randrange(400)}" for _ in range(60)]
    docs = []
    for i in range(1200):
        w = list(base)
        w[r.randrange(60)] = f"x{i}"
        docs.append((i, " ".join(w)))
    got = near_duplicates.near_duplicates(documents(spark, docs))
    assert Counter((x.doc_id, x.n_shingles, x.component_id) for x in got.collect()) == brute_components(docs, 5)


def test_an_id_on_two_texts_loses_only_the_copy(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyz")
    docs = [(1, one), (2, two), (2, one + " more"), (3, three), (3, three + " end"), (3, three), (4, None), (4, ""), (None, one)]
    got = Counter((x.doc_id, x.text) for x in near_duplicates.keep_first(documents(spark, docs)).collect())
    third = {t for d, t in got if d == 3}
    assert len(third) == 1 and third <= {three, three + " end"}
    assert got == Counter([(1, one), (2, two), (3, *third), (4, None), (4, ""), (None, one)])


def test_posterior_bound():
    # P(similarity >= 0.8 | m of n equal) under a uniform prior, integrated numerically
    s = np.linspace(0, 1, 200_001)
    for n in (32, 96, 160):
        m = near_duplicates._least_matches(n, 80, 1e-6)
        for k, enough in ((m, True), (m - 1, False)):
            density = s**k * (1 - s)**(n - k)
            assert (density[s >= 0.8].sum() / density.sum() >= 1e-6) == enough


# ---- 1

def feistel(value, key, tweak):
    n = len(value) // 2
    a, b = value[:n], value[n:]

    def shift(half, noise):
        out = ""
        for i, c in enumerate(half):
            by = int(noise[(i % 32) * 4:(i % 32) * 4 + 4], 16)
            for alphabet in (string.digits, string.ascii_lowercase, string.ascii_uppercase):
                if c in alphabet:
                    c = alphabet[(alphabet.index(c) + by) % len(alphabet)]
                    break
            out += c
        return out

    for t in range(1, pseudonyms.ROUNDS + 1):
        noise = lambda other: hashlib.sha512(f"{key}|{tweak}|{t}|{other}".encode()).hexdigest()
        if t % 2:
            a = shift(a, noise(b))
        else:
            b = shift(b, noise(a))
    return a + b


def luhn(digits):
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pseudonyms(spark):
    r = random.Random(4)
    cards = []
    while len(cards) < 60:
        c = "".join(r.choices(string.digits, k=16))
        if luhn(c):
            cards.append(c)
    rows = [f"{c} x {c}!! y {c[:4]} {c[4:8]} {c[8:12]} {c[12:]}" for c in cards]
    ips = [".".join(str(r.randrange(256)) for _ in range(4)) for _ in range(60)]
    days = [f"{r.randint(1900, 2099)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}" for _ in range(60)]
    mails = [f"ab{i}.Cd@mail7.example.com" for i in range(60)]
    ssns = [f"{r.randint(100, 665)}-{r.randint(1, 99):02}-{r.randint(1, 9999):04}" for _ in range(60)]
    left = ["4111111111111112 300.1.2.3 4.0. 2001-02-30 000-12-3456 DE88370400440532013000 v1.2.3.4.5", "", None, "plain " * 20_000]
    docs = documents(spark, list(enumerate(rows + ips + days + mails + ssns + ["+1 (743) 555-3824 12", "DE89 3704 0044 0532 0130 00"] + left)))
    new = [x.text for x in pseudonyms.pseudonymise_column(docs, "k").orderBy("doc_id").collect()]
    for c, t in zip(cards, new):
        p = t[:16]
        assert luhn(p) and p != c and p[:15] == feistel(c[:15], "k", "card") and t == f"{p} x {p}!! y {p[:4]} {p[4:8]} {p[8:12]} {p[12:]}"
    assert len(set(new[60:120])) == len(set(ips)) and all(max(map(int, t.split("."))) < 256 for t in new[60:120]) and not set(new[60:120]) & set(ips)
    assert len(set(new[120:180])) == len(set(days)) and all("1900" <= np.datetime64(t).astype(str)[:4] <= "2099" for t in new[120:180])
    assert [t.split("@")[0] for t in new[180:240]] == [feistel(m.split("@")[0].lower(), "k", "email") for m in mails]
    assert all(re.fullmatch(r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}", t) for t in new[240:300]) and len(set(new[240:300])) == len(set(ssns))
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4} 12", new[300]) and new[300] != "+1 (743) 555-3824 12"
    iban = new[301].replace(" ", "")
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1 and iban[:2] == "DE"
    assert new[302:] == left
    assert pseudonyms.pseudonymise_column(documents(spark, []), "k").count() == 0


def test_pseudonyms_at_sentence_ends_and_in_national_forms(spark):
    gone = ["ann@b.com", "ann@b.co.uk", "x.y@mail.example.org", "2021-03-04", "01 23 45 67 89", "01.23.45.67.89", "0612345678", "+33 1 23 45 67 89", "+33 (0)1 23 45 67 89",
            "030 123456", "(030) 1234567", "0171/1234567", "020 7946 0958", "612 34 56 78", "91 234 56 78", "612-345-678", "+34 612 345 678", "555 123 4567"]
    ends = [".", ". Then", ", then", "", "!", ")"]
    rows = [f"Write to {v}{e}" for v in gone for e in ends] + ["at 2021-03-04T12:00:00Z."]
    left = ["12 345 678 Euro", "612 345 678 euros.", "3.14159 and 007", "a@b", "2021-02-30T12:00", "0.5 / 0.25", "01.02. um 12 Uhr", "1234567890"]
    new = [x.text for x in pseudonyms.pseudonymise_column(documents(spark, list(enumerate(rows + left))), "k").orderBy("doc_id").collect()]
    shape = lambda t: re.sub("[a-z]", "x", re.sub("[0-9]", "9", t))
    for i, (row, t) in enumerate(zip(rows[:-1], new)):
        v, e = gone[i // len(ends)], ends[i % len(ends)]
        assert t.startswith("Write to ") and t.endswith(e) and len(t) == len(row) and shape(t) == shape(row) and v not in t, (row, t)
        assert t[9:9 + len(v)] == new[i - i % len(ends)][9:9 + len(v)]
        assert not v.startswith(("0", "(0")) or t[9:].startswith(("0", "(0"))
    assert re.fullmatch(r"at \d{4}-\d\d-\d\dT12:00:00Z\.", new[len(rows) - 1]) and new[len(rows) - 1] != rows[-1]
    assert new[len(rows):] == left


def test_spellings_of_a_phone_number_stay_linked(spark):
    groups = [["+1 743 555 3824", "+17435553824", "+1 (743) 555-3824", "(743) 555-3824", "743-555-3824"], ["+49 30 1234567", "+49301234567", "+49 (0)30 1234567", "030 1234567"],
              ["+33 1 23 45 67 89", "+33123456789", "01 23 45 67 89"], ["+351 21 234 5678", "+351212345678"], ["+7 495 123 45 67", "+74951234567"]]
    written = [s for g in groups for s in g]
    made = iter(x.text for x in pseudonyms.pseudonymise_column(documents(spark, [(i, f"Call {s} now") for i, s in enumerate(written)]), "k").orderBy("doc_id").collect())
    for code, group in zip(["1", "49", "33", "351", "7"], groups):
        found = []
        for spelled, t in zip(group, made):
            assert len(t) == len(f"Call {spelled} now") and spelled not in t, (spelled, t)
            digits = re.sub("[^0-9]", "", t)
            if "+" in spelled:
                assert digits.startswith(code)
                digits = digits[len(code):]
            found.append(digits[1:] if re.match(r"0|.*\(0\)", spelled) else digits)
        national = re.sub("[^0-9]", "", group[0])[len(code):]
        assert set(found) == {feistel(national, "k", "phone")}, found
    mails = pseudonyms.pseudonymise_column(documents(spark, [(1, "jürgen@b.com"), (2, "an jürgen@b.com."), (3, "联系me@b.com")]), "k").orderBy("doc_id").collect()
    assert re.fullmatch("[a-z]ü[a-z]{4}@b.com", mails[0].text) and mails[0].text[:1] + mails[0].text[2:6] != "jrgen" and mails[1].text == f"an {mails[0].text}."
    assert re.fullmatch("联系[a-z]{2}@b.com", mails[2].text)


# ---- 3

def test_main_text(spark):
    page = ("<html><head><title>no</title><style>p{}</style></head><body><header>Site</header><nav><a href=a>Menu</a></nav><div class='cookie-notice'>We use"
            "</div><article><h1>Head&nbsp;&amp; line</h1><script>var a='</p>'</script><p>First <b>bo</b>ld\n text &copy; of some length, as it is.<p>Second one &#233;"
            "<br>after<div class='ad'>Buy</div><section id=comments><p>" + "I say so. " * 40 + "</section></article><aside>Side</aside><footer>Foot</footer>")
    long = "<body><article>" + "<p>word </p>" * 50_000 + "</article>"
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (4, "u", "plain  text"), (None, "u", "<p>a</p><p>b"), (1, "u", page), (5, "u", long), (6, "u", "<div" * 5),
            (7, "u", "<nav><a href=x>only menu</a></nav>")]
    pages = spark.createDataFrame([(*r, "t") for r in rows], "page_id bigint, url string, html string, text string")
    got = Counter((x.page_id, x.url, x.text, x.n_chars) for x in main_text.main_texts(pages).collect())
    text = "Head & line First bold text © of some length, as it is. Second one é after"
    want = [(1, "u", text), (2, "u", ""), (3, None, ""), (4, "u", "plain text"), (None, "u", "a b"), (1, "u", text), (5, "u", " ".join(["word"] * 50_000)), (6, "u", ""), (7, "u", "")]
    assert got == Counter((*w, len(w[2])) for w in want)
    assert main_text.main_texts(pages.limit(0)).count() == 0


def test_text_without_named_elements_is_found_by_density():
    page = ("<body><div><ul>" + "".join(f"<li><a href=/{i}>Link number {i}</a>" for i in range(30)) + "</ul></div><div><h2>Title</h2>"
            + "".join(f"<p>Paragraph {i} has quite some words of running text, with <a href=x>one link</a>.</p>" for i in range(6)) + "</div></body>")
    got = main_text.extract(page)
    assert got.startswith("Title Paragraph 0 has") and got.endswith("one link.") and "Link number" not in got


def test_every_section_and_the_headline_are_taken_without_named_elements():
    para = lambda k: "<p>" + f"text{k} " * 50 + "</p>"
    parts = ["<div class=part>" + para(k) * n + "</div>" for k, n in ((1, 6), (2, 6), (3, 2))]
    links = "<ul class=more>" + "".join(f"<li><a href=/{i}>Some other story {i}</a>" for i in range(20)) + "</ul>"
    want = " ".join(["Head line"] + ["text1"] * 300 + ["text2"] * 300 + ["text3"] * 100)
    assert main_text.extract("<div><h1>Head line</h1>" + "".join(parts) + "</div>") == want
    assert main_text.extract(f"<body>{links}<div><h1>Head line</h1>" + "".join(parts) + f"</div>{links}</body>") == want
    # a block elsewhere under the body, and sections of unlike length with headings
    far = f"<div><div><h1>Head line</h1>{parts[0]}</div></div>{links}<div><div>{para(2) * 6}</div></div>"
    assert main_text.extract(far) == " ".join(["Head line"] + ["text1"] * 300 + ["text2"] * 300)
    cut = "<h1>Head line</h1><p>Lead.</p>" + "".join(f"<section><h2>Part {k}</h2>{para(k) * n}</section>" for k, n in ((1, 5), (2, 1), (3, 9)))
    assert main_text.extract(f"<div>{links}{cut}</div>") == " ".join(["Head line Lead."] + [w for k, n in ((1, 5), (2, 1), (3, 9)) for w in ["Part", str(k), *[f"text{k}"] * 50 * n]])


def test_text_outside_of_block_elements_is_taken():
    page = "<div>" + "Bare words of a page. " * 80 + "<br>and more.<div class=q>" + "<p>" + "Quoted. " * 60 + "</p><p>" + "Quoted. " * 60 + "</p></div>Last words " + "of it " * 60 + "</div>"
    assert main_text.extract(page) == " ".join(["Bare words of a page."] * 80 + ["and more."] + ["Quoted."] * 120 + ["Last words"] + ["of it"] * 60)


def test_several_articles_are_one_main_text():
    page = "<body>" + "".join(f"<article><h2>Head {k}</h2>" + f"<p>{'some text ' * 30}</p>" * n + "</article>" for k, n in ((1, 5), (2, 2))) + "<div>Bye</div></body>"
    assert main_text.extract(page) == " ".join(["Head 1"] + ["some text"] * 150 + ["Head 2"] + ["some text"] * 60)


def test_names_in_an_article_drop_only_what_they_name_as_a_whole():
    text = "Running text of an article, as long as it takes. " * 8
    kept = [f'<section id="related-work"><p>{text}</p></section>', '<h2 id="search-results">Results</h2>', '<h2 id="notice-period">Notice</h2>', '<h3 class="share">Shares</h3>',
            f'<p class="share-price">{text}</p>', f'<div id="social-impact"><p>{text}</p></div>', f'<section id="cookies"><p>{text}</p><p>{text}</p></section>']
    gone = ['<div class="share-buttons"><a href=x>Post</a> <a href=y>Mail</a></div>', '<ul class="entry-end relatedPosts"><li><a href=z>Other story</a></ul>',
            f'<div id="comments"><p>{text}No.</p></div>', '<div class="ad-300x250">Buy</div>', '<div class="newsletter">Sign up</div>']
    page = "<article><h1 id=menu>Head</h1>" + "".join(k + g for k, g in itertools.zip_longest(kept, gone, fillvalue="")) + "</article>"
    one = " ".join(text.split())
    assert main_text.extract(page) == " ".join(["Head", one, "Results", "Notice", "Shares", one, one, one, one])


# ---- 4

def test_class_bigrams(spark, texts):
    docs = documents(spark, texts)
    got = class_ngrams.score(docs).collect()
    counts = Counter()
    for doc, text in texts:
        if zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 != 2:
            counts.update([*spaced(text, lower=True), None])
    total, kinds = sum(counts.values()), len(counts)
    want = Counter()
    for doc, text in texts:
        w = [*spaced(text, lower=True), None]
        base = sum(log10((counts[x] + 1) / (total + kinds + 1)) for x in w)
        want[doc, zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), total, round(base, 5)] += 1
    assert Counter((x.doc_id, x.held_out, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 5)) for x in got) == want
    assert all(x.score < 0 for x in got)
    assert class_ngrams.score(documents(spark, [])).count() == 0


def test_classes_follow_their_neighbours(spark):
    r = random.Random(2)
    langs = [[f"{p}{i}" for i in range(60)] for p in ("ab", "xy")]
    docs = [(i, " ".join(r.choices(langs[i % 2], k=60))) for i in range(300)]
    got = class_ngrams.score(documents(spark, docs)).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.sum("n_tokens").alias("n")).first()
    assert (got.s - got.b) / got.n > 0.2  # two languages that never mix: log10(2) per word is there to be won


def test_exchange_never_lowers_the_likelihood():
    r = np.random.default_rng(0)
    units = class_ngrams.UNITS
    counts = np.zeros((2, units, class_ngrams.CLASSES))
    counts[:, :50] = r.poisson(3, (2, 50, class_ngrams.CLASSES))
    classes = np.full(units, 3, np.int8)
    classes[-1] = class_ngrams.CLASSES - 1
    moved = class_ngrams.exchange(classes, counts, 0)
    assert moved[-1] == class_ngrams.CLASSES - 1 and (moved[:50] < class_ngrams.CLASSES - 1).all() and (moved != classes).any()


# ---- 5

def test_rollups(spark, tmp_path):
    docs = documents(spark, [(1, "a b c", "en", "s"), (2, None, "en", "s"), (3, "x-y z", None, None), (3, "x-y z", None, None)])
    sums = token_rollups.Rollup(spark, str(tmp_path / "r"))
    assert sums.totals().count() == 0
    sums.commit("0", token_rollups.inserted(docs.limit(0), "spaced-1"))
    assert sums.totals().count() == 0
    for _ in range(2):
        sums.commit("1", token_rollups.inserted(docs, "spaced-1"))
    rows = lambda: {(x.source, x.lang, x.version): (x.docs, x.tokens) for x in sums.totals().collect()}
    assert rows() == {("s", "en", "spaced-1"): (2, 3), (None, None, "spaced-1"): (2, 4)}
    sums.commit("2", token_rollups.revised(docs.where("lang IS NULL"), "spaced-1", F.lit(2), F.lit(3)))
    sums.commit("3", token_rollups.deleted(docs.where("doc_id < 3"), "spaced-1"))
    sums.commit("2", token_rollups.revised(docs.where("lang IS NULL"), "spaced-1", F.lit(2), F.lit(3)))
    assert rows() == {(None, None, "spaced-1"): (2, 6)}


# ---- 8

def brute_cosine(line):
    cut = lambda t: [x for x in (re.sub(r"^[.-]+|[.-]+$", "", w) for w in re.split(r"[^0-9A-Za-z.-]+", t.translate(LOWER))) if x]
    bags = {k: Counter(cut(t)) for k, t in licences.TEMPLATES.items()}
    df = Counter(t for b in bags.values() for t in b)
    idf = lambda t: np.log((1 + len(bags)) / (1 + df[t])) + 1
    vec = lambda b: {t: n * idf(t) for t, n in b.items()}
    a = vec(Counter(cut(line)))
    best = []
    for k, b in bags.items():
        v = vec(b)
        dot = sum(a[t] * v.get(t, 0) for t in a)
        best.append((-round(dot / np.sqrt(sum(x * x for x in a.values())) / np.sqrt(sum(x * x for x in v.values())), 6), k))
    return min(best)


def test_licences(spark):
    files = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "# Licensed under the Apache License, Version 2.0.\ncode"), ("a/b/c/y.py", "code"),
             ("a/b/c/y.py", "code"), ("z.py", None), ("d/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\nmore"), ("d/e/q.py", ""),
             (None, "Licensed under CC BY-NC 4.0."), (None, "x"), ("a/f/notes", "the license of my car"), ("LICENSES.md", "Released under the MIT License.")]
    got = Counter((x.path, x.licence, x.origin) for x in licences.scan(spark.createDataFrame([(*f, "l") for f in files], "path string, text string, licence string")).collect())
    assert got == Counter([("a/LICENSE", "MIT", "own"), ("a/b/x.py", "Apache-2.0", "own"), ("a/b/c/y.py", "MIT", "inherited"), ("a/b/c/y.py", "MIT", "inherited"),
                           ("z.py", None, None), ("d/COPYING.txt", "GPL-3.0", "own"), ("d/e/q.py", "GPL-3.0", "inherited"), (None, "CC-BY-NC-4.0", "own"),
                           (None, "CC-BY-NC-4.0", "own"), ("a/f/notes", "MIT", "inherited"), ("LICENSES.md", "MIT", "own")])
    assert licences.scan(spark.createDataFrame([], "path string, text string")).count() == 0


def test_licence_cosines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    files = docs.select(F.col("doc_id").cast("string").alias("path"), "text")
    got = {x.path: (x.licence, x.similarity) for x in licences.own_licences(files).collect()}
    want = {}
    for x in files.collect():
        best = min((brute_cosine(line) for line in (x.text or "").split("\n") if re.search(licences.HINT, line)), default=(0, ""))
        if -best[0] >= licences.LEAST:
            want[x.path] = (best[1].removesuffix("-short"), -best[0])
    assert got.keys() == want.keys() and all(got[k][0] == want[k][0] and abs(got[k][1] - want[k][1]) < 2e-6 for k in want)


def test_headers_whole_files_and_identifiers(spark):
    wrap = lambda t, mark="": "\n".join(f"{mark}{x}" for x in textwrap.wrap(t, 72))
    notice = lambda name, i=0: [t for k, t in licences.NOTICES if k == name][i]
    whole = lambda name: (Path(licences.__file__).parent / f"licence_texts/{name}.txt").read_text()
    title = lambda x: f"                    GNU GENERAL PUBLIC LICENSE\n                       {x}\n"
    files = {"a/COPYING": (title("Version 2, June 1991"), "GPL-2.0"), "a/x.c": ("int x;", "GPL-2.0"), "b/COPYING": (title("Version 3, 29 June 2007"), "GPL-3.0"),
             "c/g2.c": ("/*\n * Foo, a bar\n *\n" + wrap(notice("GPL-2.0"), " * ") + "\n */\nint main() { return 0; }\n" * 40, "GPL-2.0"),
             "c/g3.py": ("#!/usr/bin/python\n# Foo (C) 2020 Ann\n#\n" + wrap(notice("GPL-3.0"), "# ") + "\n\nimport sys\n" * 40, "GPL-3.0"),
             "c/l21.h": (wrap(notice("LGPL-2.1"), "// ") + "\n#define X\n", "LGPL-2.1"), "c/none.py": ("# Foo and its bars\n\nprint(1)\n", None),
             "d/LICENSE": ("The MIT License (MIT)\n\nCopyright (c) 2020 Ann\n\n" + wrap(notice("MIT")), "MIT"), "e/LICENSE": ("Copyright 2020 Ann\n\n" + wrap(notice("BSD-3-Clause")), "BSD-3-Clause"),
             "f/LICENSE": ("Copyright 2020 Ann\n\n" + wrap(notice("BSD-2-Clause")), "BSD-2-Clause"), "g/LICENSE.txt": (whole("Apache-2.0"), "Apache-2.0"),
             "h/COPYING": (whole("GPL-2.0"), "GPL-2.0"), "h/y.c": ("", "GPL-2.0"), "i/COPYING": (whole("GPL-3.0"), "GPL-3.0"), "j/COPYING": (whole("LGPL-3.0"), "LGPL-3.0"), "k/LICENSE": (whole("MPL-2.0"), "MPL-2.0"),
             "c/m.js": ("// SPDX-License-Identifier: MIT\nlet a;", "MIT"), "c/s.js": ("/* SPDX-License-Identifier: Apache-2.0 */\nlet a;", "Apache-2.0"),
             "c/t.js": ("// SPDX-License-Identifier: GPL-3.0-or-later", "GPL-3.0"), "c/u.js": ("// SPDX-License-Identifier: Zlib", None), "c/apache.go": (wrap(notice("Apache-2.0"), "// "), "Apache-2.0")}
    rows = [(k, t) for k, (t, _) in files.items()] * 2
    got = Counter((x.path, x.licence) for x in licences.scan(spark.createDataFrame(rows, "path string, text string")).collect())
    assert got == Counter([(k, name) for k, (_, name) in files.items()] * 2)


# ---- 9

def test_both_libraries_split_the_first_code_points_alike():
    enc = byte_pairs.encoder(byte_pairs.VOCABULARY)
    for c in map(chr, range(1, 0x250)):
        for t in (f"a{c}b", f"a {c} b", f"a{c}{c} b", f"1{c}2 {c}x", f"a {c}{c} \n b'{c}s", f"  {c}  {c}."):
            assert enc.exact.encode(t, add_special_tokens=False).ids == enc.fast.encode_ordinary(t)


def test_joined_pieces_are_encoded_as_one():
    enc, r = byte_pairs.encoder(byte_pairs.VOCABULARY), random.Random(6)
    for _ in range(300):
        text = "".join(r.choice(["a", "the", " ", "  ", "\n", "'s", "é", "語", "12", ".", " word"]) for _ in range(40))
        raw, cut, pieces = text.encode(), 0, []
        while cut < len(raw):
            end = min(len(raw), cut + r.randint(1, 30))
            while end < len(raw) and raw[end] & 0xC0 == 0x80:
                end += 1
            pieces.append((raw[cut:end], enc.encode(raw[cut:end])))
            cut = end
        assert enc.join(pieces).tolist() == enc.exact.encode(text, add_special_tokens=False).ids


def test_byte_pairs(spark, texts):
    r = random.Random(8)
    shared = " ".join("".join(r.choices(string.ascii_letters, k=6)) for _ in range(1500))
    docs = texts + [(5000 + i, f"{'x ' * i}{shared}{' y' * i}<|endoftext|>z") for i in range(6)] + [(5010, "語" * 3000), (5011, "<|endoftext|>"), (5012, "a" * 5000)]
    enc = byte_pairs.encoder(byte_pairs.VOCABULARY)
    want = Counter()
    for doc, text in docs:
        ids = enc.exact.encode(text or "", add_special_tokens=False).ids
        back = enc.exact.decode(ids, skip_special_tokens=False)
        want[doc, len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()] += 1
    got = byte_pairs.encode(documents(spark, docs))
    assert Counter((x.doc_id, x.n_tokens, bytes(x.ids), x.ids_sha256, x.decoded_sha256) for x in got.collect()) == want
    assert Counter(x.text for x in byte_pairs.decode(got).collect()) == Counter(t or "" for _, t in docs)
    assert byte_pairs.encode(documents(spark, [])).count() == 0


def test_equal_passages_are_cut_alike():
    r = random.Random(5)
    passage = " ".join("".join(r.choices(string.ascii_lowercase, k=5)) for _ in range(2000)).encode()
    (_, a), (_, b), (_, none) = byte_pairs.cuts([passage, b"something before " + passage, b""])
    assert len(none) == 0 and len(a) > 5 and len(set(a.tolist()) & set(b.tolist())) >= len(a) - 2


# ---- 10

def test_toxicity(spark):
    r = random.Random(7)
    plain = [f"w{i}" for i in range(800)]
    bad = ["vile", "nasty", "awful"]
    rows, marks = [], []
    for i in range(1500):
        w = r.choices(plain, k=r.randint(5, 80))
        toxic = i % 5 == 0
        for _ in range(3 * toxic):
            w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w), r.choice(["en", "fr", None]), "s"))
        marks.append((i, int(toxic)))
    rows += [(9000, None, "en", "s"), (9001, "", "xx", "s"), (None, "w1 vile, NASTY!! w2", "en", "s"), (9002, "w5 " * 100_000 + "vile awful nasty", "en", "s"), (3, rows[3][1], "en", "s")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([*marks, (1, None), (None, 1), (7, 0)], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.toxicity(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.7) for x in got)
    held = [x for x in got if x.held_out and x.doc_id is not None and x.doc_id < 9000]
    assert {x.doc_id for x in held} == {i for i, _ in marks if zlib.crc32(str(i).encode()) % 3 == 1}
    right = sum((x.predicted == 1) == (x.doc_id % 5 == 0) for x in held)
    assert right / len(held) > 0.95
    by = {x.doc_id: x for x in got}
    assert by[9000].score == by[9001].score and by[9002].predicted == 1 and by[None].predicted == 1
    assert toxicity.toxicity(docs.limit(0), model).count() == 0
    assert toxicity.toxicity(docs.limit(3), toxicity.train(docs.limit(0), labels.limit(0))).count() == 3


# ---- pipeline

def test_pipeline_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(x.doc_id, x.text) for x in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    items = [(x.item_id, x.text) for x in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    judged = quality_rules.judge(documents(spark, docs), ["doc_id"]).where("kept").collect()
    docs = [d for d in docs if d[0] in {x.doc_id for x in judged}]
    lead = {d for d, _, c in brute_components(docs, 5) if d == c}
    docs = [d for d in docs if d[0] in lead]
    clean = {k[0] for k in brute_contamination(docs, items) if not (k[2] > 0 and 20 * k[2] >= k[1])}
    docs = [d for d in docs if d[0] in clean]
    hidden = {x.doc_id: x.text for x in pseudonyms.pseudonymise_column(documents(spark, docs), "check-key").collect()}
    enc = byte_pairs.encoder(byte_pairs.VOCABULARY)
    got = corpus_pipeline.run(spark, folder).collect()
    assert {x.doc_id: bytes(x.ids) for x in got} == {d: np.array(enc.exact.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for d, t in hidden.items()}
    assert len(got) == len(docs) and corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "decontamination", "pii", "byte_pairs"]


def test_words_and_batches(spark):
    got = spark.createDataFrame([(" a\tb\x0bc d ",), ("",), (None,)], "text string").select(words(F.col("text")).alias("w")).collect()
    assert [x.w for x in got] == [["a", "b", "c d"], [], []]
    assert in_batches(spark.range(5000), lambda bs: bs, "id bigint").count() == 5000
