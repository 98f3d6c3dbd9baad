from __future__ import annotations

import random
from collections import Counter, defaultdict

from llm_cases import saved

from ampflow.llm import url_templates as S

PAGES = "page_id long, url string, html string"
LABELS = "doc_id long, quality int, toxic int"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:end]), rest[end:]
    end = min((rest.index(c) for c in "?#" if c in rest), default=len(rest))
    return host, rest[:end]


def rule_of(host, path):
    fits = [r for r in S.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return (best.name, best.verdict) if best else (None, None)


def brute_templates(rows, labels):
    """Verdict of every ``(host, path)`` by dictionaries."""
    paths = defaultdict(lambda: [0, 0, 0])
    for page, url in rows:
        counts = paths[split(url)]
        counts[0] += 1
        if labels.get(page) is not None:
            counts[1] += 1
            counts[2] += labels[page]
    template = {key: "" for key in paths}
    segments = {}
    for key in paths:
        parts = key[1].removeprefix("/").split("/") if key[1] else []
        segments[key] = parts if len(parts) <= S.DEPTH else [*parts[: S.DEPTH], "..."]
    for level in range(max(map(len, segments.values()), default=0)):
        going = [k for k in paths if len(segments[k]) > level]
        children, nodes = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [0, 0, 0])
        for k in going:
            for store, at in ((children, (k[0], template[k], segments[k][level])), (nodes, (k[0], template[k]))):
                for i in range(3):
                    store[at][i] += paths[k][i]
        variants = Counter(c[:2] for c in children)
        branch = {}
        for c, counts in children.items():
            rare = variants[c[:2]] >= S.LEAST_VARIANTS and counts[0] < S.LITERAL_SHARE * nodes[c[:2]][0]
            branch[c] = _shape(c[2]) if rare else c[2]
        branches = defaultdict(lambda: [0, 0])
        for c, counts in children.items():
            at = (*c[:2], branch[c])
            branches[at][0] += counts[1]
            branches[at][1] += counts[2]
        moved = {}
        for k in going:
            c = (k[0], template[k], segments[k][level])
            _, labelled, bad = nodes[c[:2]]
            rate = bad / labelled if labelled else 0.0
            own = branches[(*c[:2], branch[c])]
            expected = own[0] * rate
            alike = abs(own[1] - expected) <= S.APART * (expected * (1 - rate)) ** 0.5
            moved[k] = template[k] + "/" + ("~" if alike else branch[c])
        template |= moved
    labelled, bad = sum(c[1] for c in paths.values()), sum(c[2] for c in paths.values())
    share = 1 - bad / labelled if labelled else 1.0
    sums = defaultdict(lambda: [0, 0])
    for k, counts in paths.items():
        sums[(k[0], template[k])][0] += counts[1]
        sums[(k[0], template[k])][1] += counts[2]
    out = {}
    for k in paths:
        n, b = sums[(k[0], template[k])]
        purity = (n - b + S.SMOOTHING * share) / (n + S.SMOOTHING)
        out[k] = (template[k], "block" if purity < S.LEAST_PURITY else "allow")
    return out


def _shape(segment):
    import re

    shown = "{number}" if re.search(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$", segment) else "*"
    found = re.search(r"(\.[A-Za-z][A-Za-z0-9]{0,4})$", segment)
    return shown + (found[1] if found else "")


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    hosts = ["spam.example.net", "News.Example.NET", "www.example.org", "a.com", "com", "xcom", "hot.net"]
    rows, labels = [], {}
    for page in range(900):
        host = "hot.net" if page % 3 == 0 else rng.choice(hosts)
        section = rng.choice(["en", "de", "fr", "es", "promo", "casino"])
        tail = rng.choice(["", "/", ".html", "?q=/x", "#/top", "/a/b/c/d/e/f/g/h/i"])
        rows.append((page, f"http{rng.choice(['', 's'])}://{host}/{section}/{rng.randint(1, 400)}{tail}"))
        if rng.random() < 0.6:
            labels[page] = int(rng.random() < (0.95 if section in ("promo", "casino") else 0.05))
    odd = [None, "", "no scheme/x", "http://", "HTTP://A.COM", "http://ORG/", "x://ÄB.org/es/", "http://example.org/es/1", "a://b://c/d", "http://h\nost/p?", "http://example.org/en/1"]
    rows += [(1000 + i, u) for i, u in enumerate(odd)] + [(None, "http://a.net/x"), (3, rows[3][1])]
    pages = spark.createDataFrame([(p, u, None) for p, u in rows], PAGES)
    stored = [(p, 1 - b, 0) for p, b in labels.items()] + [(None, 0, 1), (5000, None, None)]
    folder = saved(spark, tmp_path, pages=pages, labels=spark.createDataFrame(stored, LABELS))
    got = S.op7_url_templates(spark, folder).collect()
    want = brute_templates(rows, labels)
    assert len(got) == len(rows)
    blocked = 0
    for r in got:
        rule, verdict = rule_of(r.host, r.path)
        template, judged = want[(r.host, r.path)]
        assert (r.rule, r.verdict, r.template) == (rule, verdict or judged, template)
        blocked += rule is None and r.verdict == "block"
    assert Counter((r.page_id, r.host, r.path) for r in got) == Counter((p, *split(u)) for p, u in rows)
    assert blocked > 0


def test_without_labels_or_pages(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a.net/x", None)], PAGES)
    none = spark.createDataFrame([], LABELS)
    got = S.op7_url_templates(spark, saved(spark, tmp_path / "a", pages=pages, labels=none)).collect()
    assert [(r.verdict, r.rule) for r in got] == [("allow", None)]
    assert S.op7_url_templates(spark, saved(spark, tmp_path / "b", pages=pages.limit(0), labels=none)).collect() == []


def test_a_bad_section_among_many_stays_apart(spark, tmp_path):
    for sections in (12, 60):
        rows = [(s * 100 + i, f"http://hot.net/s{s}/{s * 100 + i}", None) for s in range(sections) for i in range(25)]
        labels = [(page, int(page // 100 != 7), 0) for page, _, _ in rows]
        pages, stored = spark.createDataFrame(rows, PAGES), spark.createDataFrame(labels, LABELS)
        got = S.op7_url_templates(spark, saved(spark, tmp_path / str(sections), pages=pages, labels=stored)).collect()
        assert len(got) == len(rows)
        assert all((r.verdict == "block") == (r.page_id // 100 == 7) for r in got)


def test_deep_directories_are_told_apart(spark, tmp_path):
    deep, rows = "/".join("abcdefghi"), []
    for i in range(30):
        rows += [(f"one.net/{deep}/good/{i}", 0), (f"one.net/{deep}/bad/{i}", 1)]
        rows += [(f"two.net/{deep}/{'x/' * 15}{kind}/{i}/{'y/' * (i % 3)}", bad) for kind, bad in (("good", 0), ("bad", 1))]
        rows += [(f"ends.net/{deep[:-2]}/p{i}", 0), (f"ends.net/{deep[:-2]}/p{i}/more", 1)]
        rows += [(f"same.net/{deep}/{i}/z", 0), (f"rest.net/{deep}/{i}", i % 2), (f"rest.net/{deep}/{i}/z", 1 - i % 2)]
    pages = spark.createDataFrame([(n, f"http://{u}", None) for n, (u, _) in enumerate(rows)], PAGES)
    labels = spark.createDataFrame([(n, 1 - bad, 0) for n, (_, bad) in enumerate(rows)], LABELS)
    got = S.op7_url_templates(spark, saved(spark, tmp_path, pages=pages, labels=labels)).collect()
    assert len(got) == len(rows)
    told = [r for r in got if r.host != "rest.net"]
    assert all((r.verdict == "block") == bool(rows[r.page_id][1]) for r in told)
    assert len({r.template for r in got if r.host in ("same.net", "rest.net")}) == 1
