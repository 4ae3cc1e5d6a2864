"""URL rules, personal data, outliers and benchmark leaks against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as contract
import compare
from cases import empty_docs, hard_docs, hard_rows
from lotflow.llm import outliers, pii, template_leaks, url_filter
from lotflow.llm.catalogue import LISTED, RULES
from lotflow.llm.texts import table

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(contract.TEXT_SQL))
def test_query_equals_sql(spark, name):
    assert compare.differences(contract.queries()[name](spark, DIR), compare.connect(DIR), contract.oracle_sql()[name]) == []


def test_urls_hard_rows(spark):
    urls = [
        None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?q", "http://example.net", "x://net/", "http://example.netx/", "http://xnet/en/",
        "http://www.example.com/de/1#a", "http://www.example.com/de", "a://b://org/fr/", "http://a.org/fr/x", "http://a.org?/fr/", "http://spam-farm.example.org/x",
        "http://example.net:80/en/", "x\n://É.NET/ü", "http://" + "a." * 3000 + "net/" + "p/" * 5000,
    ]
    pages = spark.createDataFrame([(n % 15, url, "v") for n, url in enumerate([*urls, urls[4]])], "page_id long, url string, verdict string")
    places = [(v, r, r.partition("/")[0], "/" + r.partition("/")[2]) for v, r in RULES] + [("block", None, p.partition("/")[0], "/" + p.partition("/")[2]) for p in LISTED]

    def judge(url):
        found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        host, path = (re.sub("[A-Z]", lambda m: m.group().lower(), found.group(1)), found.group(2)) if found else ("", "")
        fits = [p for p in places if (host == p[2] or host.endswith("." + p[2])) and path.startswith(p[3])]
        rule = max((p for p in fits if p[1]), key=lambda p: len(p[1]), default=None)
        return host, path, rule and rule[1], rule[0] if rule else "block" if fits else "allow"

    got = Counter(tuple(row) for row in url_filter.judge_urls(pages, url_filter.places(spark, RULES, LISTED)).collect())
    assert got == Counter((n % 15, *judge(url)) for n, url in enumerate([*urls, urls[4]]))
    none = url_filter.places(spark, RULES, []).limit(0)
    assert {row.verdict for row in url_filter.judge_urls(pages, none).collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), none).collect() == []


BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def plain_base(text):
    def holds(kind, part):
        digits = [int(d) for d in part if d in "0123456789"]
        if kind == "ip":
            return all(int(n) <= 255 for n in part.split("."))
        if kind == "card":
            luhn = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and luhn % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    spans = [(m.start(), list(BASE).index(kind), kind, m.end()) for kind, pattern in BASE.items() for m in pattern.finditer(text or "") if holds(kind, m.group())]
    return [(kind, begin, end) for begin, _, kind, end in sorted(spans)]


ODD = ["a@b.c@d.e.f x@y", "1.2.3.4.5.6.7.8 0010.1.1.1 256.1.1.1", "4111 1111 1111 1111 4111-1111-1111-1112", "+1 (555) 010-2030. ++12345678901 +1-", "9" * 3000 + " a@" * 500 + "1." * 2000]


def test_op5_base_spans(spark):
    docs = table(spark, DIR, "documents").select("doc_id", "text").unionAll(hard_docs(spark, ODD).selectExpr("-1 - doc_id", "text").where("doc_id IS NOT NULL").distinct())
    texts = {row.doc_id: row.text for row in docs.collect()}
    for row in pii.personal_data(docs).collect():
        base = plain_base(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{b}:{e}" for k, b, e in base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(k == kind for k, _, _ in base) for kind in BASE]
        assert {f"{k}:{b}:{e}" for k, b, e in base} <= set(row.spans.split(",")) or not base


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("mail john [at] example (dot) com now", "john [at] example (dot) com"),
        ("joe at mail dot example dot org.", "joe at mail dot example dot org"),
        ("write аdmin@exаmple.com", "аdmin@exаmple.com"),
        ("call plus one 2 zero three five five five two zero two seven ok", "plus one 2 zero three five five five two zero two seven"),
        ("card ４１１１ １１１１ １１１１ １１１１ end", "４１１１ １１１１ １１１１ １１１１"),
        ("x jo​hn@site.com", "jo​hn@site.com"),
        ("he was at the house. Look at www.example.com there", None),
        ("one two three people at home, dot the i", None),
    ],
)
def test_disguises(text, found):
    base, spans = pii.all_spans(text)
    assert not [s for s in base if found and text[s[0] : s[1]] == found]
    assert [text[b:e] for b, e, _ in spans if (b, e, _) not in base] == ([found] if found else [])
    assert (pii.redacted(text) == text) == (found is None)


def test_redact_keeps_rows_and_columns(spark):
    docs = hard_docs(spark, ["me@x.org +1 555 010 2030"])
    out = pii.with_length(pii.redact(docs))
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {row.text: row.n_chars for row in out.collect()}["<EMAIL> <PHONE>"] == 15
    assert pii.redact(empty_docs(spark)).count() == 0


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[n : n + 3]) for n in range(len(words) - 2)]
    times, covered = Counter(windows), set()
    for n, window in enumerate(windows):
        if times[window] > 1:
            covered |= {n, n + 1, n + 2}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(mark in "#*$%&|<>" for mark in text or ""), again, len(covered)


def test_op6_counts(spark):
    extra = ["a b c a b c a b", "x\nx\n\n x\nx", "a b a b a b", "#*$%&|<> a", "a  b\u00a0c\u0085 d"]
    rows = outliers.judge(hard_docs(spark, extra)).collect()
    texts = {row[0]: row[1] for row in hard_rows(extra)}
    assert len(rows) == len(hard_rows(extra))
    for row in rows:
        counts = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert counts == plain_counts(texts[row.doc_id])
        assert row.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0]) and not (row.base_failed and row.kept)
    assert outliers.judge(empty_docs(spark)).collect() == []


def test_op6_finds_outliers(spark):
    sf = "/root/testdata/sf0.01"
    rows = contract.queries()["op6_robust_outliers"](spark, sf).join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed").collect()
    assert all(row.kept == (row.distance <= outliers.CUTOFF) for row in rows)
    good, bad = [r.kept for r in rows if r.quality == 1], [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.05 * len(bad) + 1


def plain_leaks(docs, items):
    """Every window of every document against every window of every item, one by one."""
    codes = template_leaks.WordCache(template_leaks.chunk_code)

    def cut(text):
        hashes, places, kind, value = template_leaks.template_windows(text, codes)
        width = template_leaks.WIDTH
        return [(h, p, tuple(value[p : p + width][kind[p : p + width] != 0].tolist())) for h, p in zip(hashes.tolist(), places.tolist())]

    cut_items, found = {n: cut(text) for n, text in items}, {}
    for number, text in docs:
        mine = cut(text)
        for item, theirs in cut_items.items():
            shifts = defaultdict(list)
            for h, p, slots in mine:
                for g, q, meant in theirs:
                    if h == g:
                        shifts[p - q].append((q, meant, slots))
            places, same = set(), True
            for held in shifts.values():
                pairs = {pair for _, meant, slots in held for pair in zip(meant, slots)}
                if len(pairs) == len({a for a, _ in pairs}):
                    places |= {q for q, _, _ in held}
                    same &= all(a == b for a, b in pairs)
            if theirs and len(places) >= 0.8 * len(theirs):
                found[number, item] = (len(places) / len(theirs), same)
    return found


QUESTION = "A train leaves Berlin at 10 km per hour and Anna walks 10 miles while Tom Smith pays 25 euros for the ticket to Berlin today."


def test_leaks_against_brute_force(spark):
    other = QUESTION.replace("10", "17").replace("Berlin", "Oslo").replace("Anna", "Eva")
    torn = QUESTION.replace("10 km", "17 km")  # 10 once as 17 and once as 10
    texts = [f"Before it. {QUESTION} After it.", f"Before it. {other}", torn, QUESTION[:40], QUESTION * 3, other]
    docs = hard_docs(spark, texts)
    items = [(1, QUESTION), (2, ""), (3, None), (4, "one"), (5, "1 2 3 4 5 6 7"), (1, QUESTION), (6, "the same words all over the same words all over")]
    bench = spark.createDataFrame([(*row, 7) for row in items], "item_id long, text string, doc_id long")
    got = {(r.doc_id, r.item_id): (r.coverage, r.same_values) for r in template_leaks.leaks(docs, bench).collect()}
    assert got == plain_leaks({row[:2] for row in hard_rows(texts)}, {row for row in items})
    first = 9
    assert got[first, 1][1] and not got[first + 1, 1][1] and (first + 2, 1) not in got and (first + 3, 1) not in got
    assert template_leaks.leaks(empty_docs(spark), bench).count() == template_leaks.leaks(docs, bench.limit(0)).count() == 0
    left = template_leaks.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - docs.join(spark.createDataFrame([(k[0],) for k in got], "doc_id long").distinct(), "doc_id", "left_semi").count()


def test_op1_finds_planted_passages(spark):
    sf = "/root/testdata/sf0.01"
    items = [row.text for row in table(spark, sf, "benchmark").collect()]
    holders = {row.doc_id for row in table(spark, sf, "documents").collect() if any(item.replace("\n", " ") in row.text.replace("\n", " ") for item in items)}
    assert holders and holders <= {row.doc_id for row in contract.queries()["op1_template_leaks"](spark, sf).collect()}
