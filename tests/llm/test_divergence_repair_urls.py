"""Source divergence, conversation repair and URL models against brute force and on odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from check import compare
from cohortry.llm import divergence, repair, urls
from pyspark.sql import functions as F

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def divergence_by_hand(rows):
    """{(lang, source, part, item): (value, rank)} of (text, lang, source)."""
    docs = [(TERM.findall(lowered(t)), lang or "", source or "") for t, lang, source in rows]
    out = {}
    for lang in {d[1] for d in docs}:
        df, n = collections.Counter(), collections.defaultdict(collections.Counter)
        for terms, own, source in docs:
            if own == lang:
                df.update(set(terms))
                n[source].update(terms)
        kept = [t for t in df if df[t] >= 3]
        n = {s: {t: c[t] for t in kept if c[t]} for s, c in n.items()}

        def shares(c):
            total = sum(c.values()) + len(kept)
            return {t: 1 + 10**9 * (c.get(t, 0) + 1) // total for t in kept}
        p = {s: shares(c) for s, c in n.items()}
        q = shares(sum((collections.Counter(c) for c in n.values()), collections.Counter()))
        for s in n:
            pair = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o.encode(), o) for o in n if o != s]
            term = [(-((p[s][t] - q[t]) ** 2 // q[t]), t.encode(), t) for t in n[s] if p[s][t] > q[t]]
            for part, items in (("pair", sorted(pair)), ("term", sorted(term)[:200])):
                for rank, (value, _, item) in enumerate(items, 1):
                    out[lang, s, part, item] = (-value, rank)
    return out


ODD_TEXTS = [
    ("a b c été ÉTÉ x", "fr", "s1"), ("a b c été x x", "fr", "s2"), ("a a c é x", "fr", None), (None, "fr", "s4"),
    ("A B C été", "fr", "s1"), ("A B C été", "fr", "s1"), ("only one", "xx", "alone"), ("only one", "xx", "alone"),
    ("only one", "xx", "alone"), ("", None, None), (None, None, "s1"), ("1 2 3 _ - \x00", "en", "empty"),
    ("z\u00a0z z", "fr", "s\U0001f600"), ("z\u00a0z z", "fr", "s\uffee"), ("z\u00a0z z b", "fr", "s9"),
    ("long " * 60_000 + "tail", "fr", "s2"),
]


def told(df):
    got = [((r.lang, r.source, r.part, r["item"]), (r.value, r["rank"])) for r in df.collect()]
    assert len(dict(got)) == len(got)
    return dict(got)


def test_divergence_of_odd_texts(spark):
    df = spark.createDataFrame(ODD_TEXTS, "text string, lang string, source string")
    assert told(divergence.op11(df)) == divergence_by_hand(ODD_TEXTS)
    extra = df.withColumns({c: F.lit("mine") for c in ("term", "i", "p", "z", "value", "rank", "item", "n", "doc_id")})
    assert told(divergence.op11(extra)) == divergence_by_hand(ODD_TEXTS)


@pytest.mark.parametrize("entries,pairs,tally", [(200_000, 1_000_000, 300_000), (7, 5, 20), (1, 1, 1)])
def test_divergence_in_any_parts(spark, monkeypatch, entries, pairs, tally):
    for name, size in (("ROW_ENTRIES", entries), ("NODE_PAIRS", pairs), ("TALLY", tally), ("LIST_BYTES", 64)):
        monkeypatch.setattr(divergence, name, size)
    rng = random.Random(entries)
    words = [f"w{chr(97 + i)}" for i in range(25)]
    rows = [(" ".join(rng.choices(words, weights=range(25, 0, -1), k=rng.randint(0, 30))), rng.choice(["en", "de"]),
             f"s{min(rng.randint(0, 9), rng.randint(0, 9))}") for _ in range(120)]
    df = spark.createDataFrame(rows, "text string, lang string, source string").repartition(4)
    assert told(divergence.op11(df)) == divergence_by_hand(rows)


def test_tree_nodes_hold_the_terms_below():
    paths = sorted((random.Random(i).sample(range(6), random.Random(i + 99).randint(1, 6)) for i in range(40)))
    lengths = np.array([len(p) for p in paths])
    values = np.array([list(itertools.chain(*paths))] * 3)
    common = divergence._common(lengths, np.zeros(40, int), values)
    for i in range(1, 40):
        same = [a == b for a, b in zip(paths[i - 1], paths[i])]
        assert common[i] == (same + [False]).index(False)
    got = {tuple(paths[r][:d + 1]): n for rows, d, counts in divergence._nodes(lengths, common, np.arange(40))
           for r, n in zip(rows, counts)}
    want = collections.Counter()
    for i, p in enumerate(paths):
        for d in range(len(p)):
            want[tuple(p[:d + 1])] += i
    assert got == {k: v for k, v in want.items() if k in got} and set(got) == set(want)


def cheapest(signature):
    """(cost, audit) by trying every edit, with at most two insertions in a row."""
    sys.setrecursionlimit(50_000)
    best = {}

    def go(rest, q, inserted):
        key = (rest, q, inserted)
        if key not in best:
            ways = [(0, "")] if not rest and q in (0, 3) else []
            if inserted < 2:
                c, a = go(rest, repair.NEXT[q], inserted + 1)
                ways.append((3 + c, "I" + a))
            if rest:
                letter, cut = rest[0], 3 * rest[0].isupper()
                c, a = go(rest[1:], q, 0)
                ways.append((4 + c, "D" + a))
                if letter != "d":
                    c, a = go(rest[1:], repair.NEXT[q], 0)
                    ways.append((3 + cut + c, "R" + a))
                    then = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(letter.lower(), {}).get(q)
                    if then:
                        c, a = go(rest[1:], then, 0)
                        ways.append((cut + c, "K" + a))
            best[key] = min(ways, default=(10**6, ""))
        return best[key]
    return go(signature, 0, 0)


def test_every_short_signature_is_repaired_at_least_cost():
    automaton = repair.Automaton()
    for n in range(5):
        for letters in sorted(itertools.product("aAdsSuUxX", repeat=n)):
            automaton.move("".join(letters))
            assert automaton.best() == cheapest("".join(reversed(letters)))


def test_nodes_of_shared_ends_are_made_once(monkeypatch):
    made = []
    monkeypatch.setattr(repair.Automaton, "_step", lambda self, letter, step=repair.Automaton._step: (
        made.append(letter), step(self, letter)))
    automaton = repair.Automaton()
    ends = sorted({"".join(random.Random(i).choices("uad", k=random.Random(-i).randint(0, 9))) for i in range(300)})
    for e in ends:
        automaton.move(e)
    assert len(made) == len({e[:k] for e in ends for k in range(1, len(e) + 1)})


def repaired_by_hand(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, digest)} of undamaged rows."""
    by_conv, space = collections.defaultdict(list), "\t\n\x0b\x0c\r "
    for conv, turn, role, text in rows:
        by_conv[conv]
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by_conv[conv] += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (1 + (kind == 3))
    out = {}
    for conv, said in by_conv.items():
        said.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, signature, n = set(), "", collections.Counter()
        for _, role, text in said:
            known = role[:1] if role[:1] in "sua" and role else "x"
            if not text.strip(space):
                fault, known = "blank", "d"
            elif (role, text) in seen:
                fault, known = "duplicate", "d"
            elif text.rstrip(space)[-1] not in ".!?":
                fault, known = "truncated", known.upper()
            else:
                fault = "fine"
            seen.add((role, text))
            n[fault] += 1
            signature += known
        turns = [t for t, _, _ in said if t is not None]
        cost, audit = cheapest(signature)
        lines, at, q = [], 0, 0
        for e in audit:
            role, text = ("", "") if e == "I" else said[at][1:]
            at += e != "I"
            if e == "K":
                q = repair.KEPT[role[0]][q]
            elif e != "D":
                q = repair.NEXT[q]
                role = {2: "user", 3: "assistant"}[q]
            if e != "D":
                lines.append(f"{role}:{text}")
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, n["blank"], n["duplicate"],
                     n["truncated"], sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])),
                     cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_talk():
    rng, texts = random.Random(5), ["fine.", "cut", "cut \n", "", " \t", None, "why?", "fine.", "é\u00a0", "…", "end.\n "]
    rows = [(None, None, None, None), (None, 3, "user", "hm."), (1, None, "user", "x."), (1, None, "user", "x."),
            (2, 5, "", "no role."), (2, 5, "", "no role, again"), (2, 2**62, "assistant", "far."), (2, -2**62, "user", "off."),
            (3, 0, "system", "s."), (3, 1, "tool", "t"), (3, 1, "User", "case."), (4, 0, "user", "w " * 200_000)]
    for conv in range(10, 150):
        rows += [(conv, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", "tool", None, "u"]),
                  rng.choice(texts)) for _ in range(rng.randint(0, 9))]
    return rows + [(1000, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(3000)] + [(1001, 7, "user", "again.")] * 700


TALK = "conv_id long, turn long, role string, text string"


def test_repair_of_odd_conversations(spark):
    rows = odd_talk()
    df = spark.createDataFrame(rows, TALK).repartition(5)
    want = repaired_by_hand(rows)
    for given in (df, df.withColumns({c: F.lit("mine") for c in ("copies", "letter", "at", "ends", "cost", "audit", "_c")})):
        got = [tuple(r) for r in repair.op12(given).collect()]
        assert len(got) == len(want) and {r[0]: r[1:] for r in got} == want


def test_repaired_rows_match_the_grammar(spark):
    plans, rows = repair.repair(repair.damage(spark.createDataFrame(odd_talk(), TALK)))
    said = collections.defaultdict(list)
    for r in rows.where("at >= 0").collect():
        said[r.conv_id].append((r["at"], r.edit, r.role, r.text))
    for plan in plans.collect():
        turns = sorted(said[plan.conv_id])
        assert [t[0] for t in turns] == list(range(len(turns)))
        assert re.fullmatch("(s?(ua)+)?", "".join(t[2][0] for t in turns))
        assert [t[1] for t in turns] == [e for e in plan.audit if e != "D"]
        assert all(t[3] == "" for t in turns if t[1] == "I")


def urls_by_hand(given):
    """[(host, path, rule, verdict, margin)] of urls."""
    out, order, counts = [], urls.ORDER, [collections.Counter() for _ in range(2)]
    for u in given:
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match("[^/?#]*", rest).group()
        path = re.match("[^?#]*", rest[len(host):]).group()
        host = lowered(host)
        fits = [(len(h + p), len(h), h + p, v) for v, h, p in urls.RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits)[2:] if fits else (None, None)
        padded = "\x01" * order + host + path + "\x02"
        held = hashlib.md5((host + path).encode()).hexdigest() < "33"
        out.append([host, path, rule, verdict, held, [padded[i:i + order + 1] for i in range(len(padded) - order)]])
        if rule and not held:
            counts[verdict == "allow"].update(out[-1][5])
    tables = []
    for c in counts:
        n, total, kinds = (collections.defaultdict(int) for _ in range(3))
        for k in range(order + 1):
            for g, m in c.items():
                n[g[order - k:]] += m
            for g in {g[order - k:] for g in c}:
                total[k, g[:-1]] += n[g]
                kinds[k, g[:-1]] += 1
        tables.append((n, total, kinds))

    def chance(table, gram):
        p = 1 / 256
        for k in range(order + 1):
            g = gram[order - k:]
            n, total, kinds = table[0].get(g, 0), table[1].get((k, g[:-1]), 0), table[2].get((k, g[:-1]), 0)
            p = (n + kinds * p) / (total + kinds) if total else p
        return p
    ratio = {g: math.floor((math.log(chance(tables[1], g)) - math.log(chance(tables[0], g))) * 2**20 + 0.5)
             for o in out for g in o[5]}
    bins = [math.floor(sum(ratio[g] for g in o[5]) / len(o[5]) / 2**20 * 1000) for o in out]
    tried = [(b, o[3] == "allow") for b, o in zip(bins, out) if o[2] and o[4]]
    yes, no = sum(a for _, a in tried), sum(not a for _, a in tried)
    cut = min(((sum(a and b < c for b, a in tried) * no + sum(not a and b >= c for b, a in tried) * yes, abs(c), c)
               for t, _ in tried for c in {t, t + 1, 0} if c <= max(tried)[0]), default=(0, 0, 0))[2] if yes and no else 0
    return [(o[0], o[1], o[2], o[3] or ("allow" if b >= cut else "block"), None if o[2] else b - cut)
            for o, b in zip(out, bins)]


ODD_URLS = [None, "", "no scheme.org/x", "://", "http://", "http://ORG/", "http://a.ORG/x?y://z", "http://xorg/", "http://example.org/es/",
            "http://b.example.org/es/1", "http://example.org/en/12", "http://example.org/en/2", "http://example.org/es",
            "http://example.com/fr/a#b", "http://example.com/de/", "http://example.com?x/fr/", "http://x.org", "ftp://u@h.net:80/p\n/q",
            "http://é.Éxample.net/\U0001f600", "http://long.net/" + "ab" * 50_000, "http://a.org/\x01\x02", "x://y.com/de/://z.org/"]


def test_urls_by_rules_and_models(spark, sf_dir):
    given = [r.url for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()] + ODD_URLS + ODD_URLS[:6]
    df = spark.createDataFrame(list(enumerate(given)), "page_id long, url string").repartition(3)
    want = urls_by_hand(given)
    for pages in (df, df.withColumns({c: F.lit("mine") for c in ("host", "path", "rule", "rid", "gram", "bin", "row", "margin")})):
        got = {r.page_id: tuple(r)[1:] for r in urls.op13(pages).collect()}
        assert [got[i] for i in range(len(given))] == want
    assert {w[3] for w in want if w[4] is not None} == {"allow", "block"}


def test_models_tell_urls_of_kinds_apart(spark):
    rng = random.Random(3)

    def word(letters):
        return "".join(rng.choices(letters, k=9))
    given = [f"http://{word('abcdef')}.org/{word('abcdef')}" for _ in range(300)]
    given += [f"http://{word('uvwxyz')}.com/de/{word('uvwxyz')}" for _ in range(300)]
    asked = [f"http://{word(k)}.net/{word(k)}" for k in ("abcdef", "uvwxyz") for _ in range(50)]
    got = {r.page_id: r.verdict for r in urls.op13(spark.createDataFrame(
        list(enumerate(given + asked)), "page_id long, url string")).collect()}
    said = [got[600 + i] for i in range(100)]
    assert said[:50].count("allow") >= 48 and said[50:].count("block") >= 48


def test_urls_without_decided_ones(spark):
    df = spark.createDataFrame([(1, "http://a.net/x"), (2, None), (None, "http://b.net/y")], "page_id long, url string")
    assert {(r.page_id, r.verdict, r.margin) for r in urls.op13(df).collect()} == {(1, "allow", 0), (2, "allow", 0), (None, "allow", 0)}


@pytest.mark.parametrize("name", ["op11_fp_tree", "op12_dawg", "op13_url_models"])
def test_odd_rows_equal_sql(spark, tmp_path, name):
    from cohortry.llm.workload import ORACLES, QUERIES
    import pyarrow.parquet as pq
    con = duckdb.connect()
    tables = {"documents": (ODD_TEXTS, ["text", "lang", "source"]), "conversations": (odd_talk()[:-3700], ["conv_id", "turn", "role", "text"]),
              "pages": (list(enumerate(ODD_URLS)), ["page_id", "url"])}
    for t, (rows, names) in tables.items():
        pq.write_table(pa.table({c: [r[i] for r in rows] for i, c in enumerate(names)}), tmp_path / f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet'")
    assert compare(spark, con, str(tmp_path), name, QUERIES[name], ORACLES[name]) is None
