"""URL filters against plain Python: rules, shapes, the template tree and its verdicts."""

import re
from collections import Counter, defaultdict

import pytest

import __spark_entry__ as entry
from compare import connect, differences
from corpus import SF_DIR
from relocate.llm import url_filters
from relocate.llm.url_filters import RULES, Tree

UPPER = {chr(c): chr(c + 32) for c in range(65, 91)}


def plain_parts(url):
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(UPPER.get(c, c) for c in host), path


def plain_rule(host, path):
    fits = []
    for verdict, rule in RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


def plain_shape(path, depth):
    parts = [
        "{id}" if re.fullmatch("[0-9A-Fa-f-]{16,}", s) else re.sub("[0-9]+", "{n}", s) for s in path.split("/")
    ]
    return "/".join([*parts[: depth + 1], "**"] if len(parts) > depth + 1 else parts)


def plain_tree(pages, labels, tree):
    """``(host, shape) -> (template, verdict)``, grown node by node."""
    known = defaultdict(list)
    for doc_id, quality in labels:
        if quality is not None:
            known[doc_id].append(quality)
    sums = defaultdict(lambda: [0, 0, 0])
    for page_id, url in pages:
        host, path = plain_parts(url)
        held = sums[host, plain_shape(path, tree.depth)]
        held[0] += 1
        if known.get(page_id) and page_id is not None:
            held[1] += 1
            held[2] += min(known[page_id])
    prefix = {key: "" for key in sums}
    for level in range(1, tree.depth + 2):
        nodes = defaultdict(lambda: defaultdict(lambda: [0, 0, 0]))
        for (host, shape), held in sums.items():
            parts = shape.split("/")
            if len(parts) > level:
                node = nodes[host, prefix[host, shape]][parts[level]]
                node[:] = [a + b for a, b in zip(node, held, strict=True)]
        steps = {}
        for node, children in nodes.items():
            all_n, all_m, all_g = map(sum, zip(*children.values(), strict=True))
            token = {
                s: "*" if len(children) > 1 and (n < 2 or n * tree.branches < all_n) else s
                for s, (n, _, _) in children.items()
            }
            branches = defaultdict(lambda: [0, 0])
            for s, (_, m, g) in children.items():
                branches[token[s]][0] += m
                branches[token[s]][1] += g
            above = all_g / all_m if all_m else 0.5
            order = sorted(((g + above * tree.prior) / (m + tree.prior), t, m, g) for t, (m, g) in branches.items())
            clusters, m1, g1 = [[]], 0, 0
            for _, t, m, g in order:
                gap, both_m, both_g = float(g1 * m - g * m1), float(m1 + m), float(g1 + g)
                if gap * gap * both_m <= float(m1) * float(m) * both_g * (both_m - both_g) * tree.similar:
                    clusters[-1].append(t)
                    m1, g1 = m1 + m, g1 + g
                else:
                    clusters.append([t])
                    m1, g1 = m, g
            whole = len(clusters) == 1 and len(order) > 1
            names = {t: "*" if whole else "|".join(sorted(c)) for c in clusters for t in c}
            steps.update({(*node, s): names[t] for s, t in token.items()})
        for host, shape in sums:
            parts = shape.split("/")
            if len(parts) > level:
                prefix[host, shape] += "/" + steps[host, prefix[host, shape], parts[level]]
    found, hosts = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0])
    for (host, shape), (_, m, g) in sums.items():
        for held in (found[host, prefix[host, shape]], hosts[host]):
            held[0] += m
            held[1] += g
    total = [sum(x) for x in zip(*hosts.values(), strict=True)] or [0, 0]
    share = total[1] / total[0] if total[0] else 0.5
    out = {}
    for (host, shape), template in prefix.items():
        rate = (hosts[host][1] + share * tree.prior) / (hosts[host][0] + tree.prior)
        purity = (found[host, template][1] + rate * tree.prior) / (found[host, template][0] + tree.prior)
        out[host, shape] = template, "allow" if purity >= tree.limit else "block"
    return out


def plain_verdicts(pages, labels, tree):
    learned = plain_tree(pages, labels, tree)
    out = Counter()
    for page_id, url in pages:
        host, path = plain_parts(url)
        template, verdict = learned[host, plain_shape(path, tree.depth)]
        rule, fixed = plain_rule(host, path)
        out[page_id, host, path, rule, fixed or verdict, template] += 1
    return out


def judged(spark, pages, labels, tree=Tree()):
    schema = "page_id long, url string, host string, N int, _good string"
    frame = spark.createDataFrame([(*p, "own", 1, "x") for p in pages], schema)
    known = spark.createDataFrame(labels, "doc_id long, quality int")
    found = url_filters.judge(frame, known, tree=tree).drop("purity")
    return Counter(map(tuple, found.select("page_id", "host", "path", "rule", "verdict", "template").collect()))


def test_query_and_its_sql(spark):
    found = entry.queries()["op12_url_filters"](spark, SF_DIR)
    assert differences(found, connect(SF_DIR), entry.oracle_sql()["op12_url_filters"]) == []
    read = lambda name, *cols: [
        tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{name}.parquet").select(*cols).collect()
    ]
    plain = plain_verdicts(read("pages", "page_id", "url"), read("labels", "doc_id", "quality"), Tree())
    rows = found.select("page_id", "host", "path", "rule", "verdict", "template").collect()
    assert Counter(map(tuple, rows)) == plain


ODD = [
    (1, None), (2, ""), (3, "no scheme/at/all"), (4, "http://"), (5, "HTTP://A.Example.NET"), (6, "x://net/"),
    (7, "x://sub.net"), (8, "x://example.net/en/1"), (9, "x://deep.EXAMPLE.net/en/"), (10, "x://badexample.net/en/"),
    (11, "x://example.com/de/a?x=://y"), (12, "x://example.com/den/a"), (13, "x://org/fr/"), (14, "x://a.org/fr"),
    (15, "x://a.org/fr/#/x"), (16, "x://h?q=/net/"), (17, "x://É.org//a//b/"), (18, "a://b://c/d"), (None, "x://h/1"),
    (5, "x://h/1"), (20, "x://h\n/new\nline"), (21, "x://h/" + "/".join("abcdefghijkl") + "/" + "z" * 9000),
    (22, "x://h/0123456789abcdef-00/p"), (23, "x://user:pw@host:80/p"), (23, "x://user:pw@host:80/p"),
]


def test_odd_pages(spark):
    labels = [(5, 0), (5, 1), (8, None), (22, 1), (23, 0), (None, 0), (99, 1)]
    assert judged(spark, ODD, labels) == plain_verdicts(ODD, labels, Tree())
    assert judged(spark, ODD, []) == plain_verdicts(ODD, [], Tree())
    assert judged(spark, [], labels) == Counter()


@pytest.mark.parametrize("tree", [Tree(), Tree(depth=2, branches=8, limit=0.5)])
def test_branches_are_told_apart_by_their_labels(spark, tree):
    """Two bad branches become one template, good ones another; slugs are a wildcard, and so is depth."""
    pages, labels = [], []
    for i in range(600):
        kind = ("win", "bet", "news", "blog", f"slug-{i}")[i % 5]
        pages.append((i, f"http://h.test/{kind}/x{i % 3}/{i}" + "/deep" * (i % 4)))
        bad = kind in ("win", "bet")
        labels.append((i, int(i % 11 == 0 if bad else i % 12 != 2)))
    found = judged(spark, pages, labels, tree)
    assert found == plain_verdicts(pages, labels, tree)
    verdicts = {k[5].split("/")[1]: k[4] for k in found}
    assert {t: v for t, v in verdicts.items() if "win" in t} == {"bet|win": "block"}
    assert {v for t, v in verdicts.items() if "win" not in t} == {"allow"}
