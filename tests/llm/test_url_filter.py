import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tokenloom.llm.queries import URL_RULES
from tokenloom.llm.url_filter import END, LARGEST, ORDER, START, STEPS, Markov, url_verdicts

SCHEMA = "page_id long, url string, html string, id long, host string, score string, `group` int, text string"


def urls():
    rng = random.Random(2)
    name = lambda: "".join(rng.choice("thrnaeio") for _ in range(rng.randint(2, 8)))
    rows = []
    for i in range(500):
        sub = rng.choice(["", "www.", "blog.", "m."])
        rows.append(f"http{'s' * (i % 2)}://{sub}{name()}.example.{rng.choice(['com', 'net', 'org'])}/{rng.choice(['en', 'es', 'fr', 'de'])}/{i}{rng.choice(['', '?page=2', '#top', '.html'])}")
    rows += ["http://www.example.com/en/1", "http://example.com/en/1", "http://EXAMPLE.com/en", "http://example.com/EN/x", "http://com", "http://com/", "http://com?x=/en/"]
    rows += ["http://com.org/en/", "http://xcom/", "http://a.net/es/1", "ftp://net/fr/", "http://net/frx", None, "", "no scheme", "://", "://x/", "a://b://c/d", "http://a.com/é/日本\x02\x03\n#?"]
    rows += ["http://long.example.org/" + "abcdefghij/" * 3000, "http://long.example.com/" + "x" * 5000] + ["http://copy.example.org/en/1"] * 5 + ["http://copy.example.com/de/1"] * 5
    return [(None if i == 7 else i, u, "<p>", 1, "clash", "clash", 9, "clash") for i, u in enumerate(rows)]


def plain(url):
    """(host, path, rule, verdict of the rule)."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest)[0]
        path = re.split("[?#]", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in URL_RULES:
        h, p = rule.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (not best or len(rule) > len(best[0])):
            best = rule, verdict
    return host, path, *(best or (None, None))


def counts(texts):
    out = Counter()
    for t in texts:
        s = START + t + END
        out.update(s[i:j] for i in range(len(s)) for j in range(i + 1, min(len(s), i + ORDER + 1) + 1))
    return out


def chance(n, symbols, ctx, c):
    """Witten and Bell's chance, by recursion from the longest context."""
    lower = chance(n, symbols, ctx[1:], c) if ctx else 1 / (symbols + 1)
    after = {s: v for s, v in n.items() if len(s) == len(ctx) + 1 and s.startswith(ctx) and s != START} if ctx not in n.get("#", {}) else n["#"][ctx]
    seen = n.get(ctx, 0) if ctx else sum(after.values())
    if not seen:
        return lower
    return (n.get(ctx + c, 0) + (len(after) + seen - sum(after.values())) * lower) / (seen + len(after))


def brute(rows, halves, share):
    """The verdicts by plain loops."""
    known = [plain(u) for _, u, *_ in rows]
    groups = [2 if k[2] is None else h for k, h in zip(known, halves)]
    texts = [k[0] + k[1] for k in known]
    of = {(g, v): counts(t for t, k, x in zip(texts, known, groups) if k[3] == v and x == g) for g in (0, 1) for v in ("allow", "block")}
    size = sum(v for n in of.values() for s, v in n.items() if len(s) == 1 and s != START)
    whole = sum(of.values(), Counter())
    least = max(2, -(-size // share))

    def models(gs):
        two = [{s: sum(of[g, v][s] for g in gs) for s in whole if whole[s] >= least} for v in ("allow", "block")]
        two = [{s: v for s, v in n.items() if v} for n in two]
        symbols = len({s for n in two for s in n if len(s) == 1 and s != START})
        for n in two:
            after = {}
            for s, v in n.items():
                if s != START:
                    after.setdefault(s[:-1], {})[s] = v
            n["#"] = after
        return two, symbols

    by_group = {0: models([1]), 1: models([0]), 2: models([0, 1])}
    scores = []
    for t, g in zip(texts, groups):
        (a, b), symbols = by_group[g]
        s = START + t + END
        at = [(s[max(0, i - ORDER) : i], s[i]) for i in range(1, len(s))]
        distinct = Counter(at)
        scores.append(sum(k * (math.log(chance(a, symbols, *x)) - math.log(chance(b, symbols, *x))) for x, k in distinct.items()) / len(at))
    steps = [math.floor(max(-LARGEST, min(LARGEST, s)) * STEPS) for s in scores]
    ok = [(t, k[3]) for t, k in zip(steps, known) if k[2]]
    n_a, n_b = sum(v == "allow" for _, v in ok), sum(v == "block" for _, v in ok)

    def gain(t):
        return sum(s >= t and v == "allow" for s, v in ok) * n_b - sum(s >= t and v == "block" for s, v in ok) * n_a

    every = range(min(steps), max(steps) + 1)
    cut = min(every, key=lambda t: (-gain(t), abs(t), t)) / STEPS if n_a and n_b else 0
    return [(r[0], k[0], k[1], k[2], k[3] or ("allow" if s >= cut else "block"), s) for r, k, s in zip(rows, known, scores)]


def test_equals_brute_force(spark):
    rows = urls()
    keys = [(plain(r[1])[0], plain(r[1])[1]) for r in rows]
    half = F.pmod(F.xxhash64("h", "p"), F.lit(2))
    halves = [r[0] for r in spark.createDataFrame([(i, h, p) for i, (h, p) in enumerate(keys)], "i int, h string, p string").orderBy("i").select(half).collect()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for share in (1 << 17, 300):
        got = url_verdicts(df, URL_RULES, share=share)
        assert got.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
        exact = lambda rs: sorted((str(r[:5]), round(r[5], 9)) for r in rs)
        assert exact(map(tuple, got.collect())) == exact(brute(rows, halves, share))
    verdicts = {(v, r is None) for _, _, _, r, v, _ in map(tuple, got.collect())}
    assert len(verdicts) == 4  # the models both allow and block


def test_no_rows_and_no_rules(spark):
    assert url_verdicts(spark.createDataFrame([], SCHEMA), URL_RULES).collect() == []
    some = spark.createDataFrame(urls()[:4], SCHEMA)
    assert {tuple(r) for r in url_verdicts(some, []).select("rule", "verdict", "score").collect()} == {(None, "allow", 0.0)}


def test_chances_add_up_to_one():
    n = counts(["abab", "abc", "xyz"])
    full = Markov(dict(n), 7)
    pruned = Markov({s: v for s, v in n.items() if v > 1}, 7)
    for m in (full, pruned):
        symbols = sorted({s for s in m.n if len(s) == 1 and s != START})
        for ctx in ("", "a", "ab", START + "ab", "zz"):
            unseen = 8 - len(symbols)
            assert math.isclose(sum(m.chance(ctx, c) for c in symbols) + unseen * m.chance(ctx, "?"), 1.0)


def test_learns_what_rules_say(spark):
    """Urls like the blocked ones are blocked, urls like the allowed ones allowed."""
    rng = random.Random(4)
    rows = [(i, f"http://h{rng.randint(0, 99)}.{'com' if i % 2 else 'net'}/{'es' if i % 2 == 0 else 'de'}/{'casino' if i % 2 == 0 else 'garden'}-{i}") for i in range(400)]
    rows += [(1000 + i, f"http://h{i}.org/xx/{w}-{i}") for i in range(20) for w in ("casino", "garden")]
    got = url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES)
    for r in got.where("rule IS NULL").collect():
        assert r.verdict == ("block" if "casino" in r.path else "allow")
