"""The operators against brute force, on odd rows, and with columns of clashing names."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from cohortry.llm import (chat, components, decontamination, extraction, language, mixing, neardup, quality,
                          sharding, substrings, tokens, toxicity)
from cohortry.operators import materialise
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=4):
    w = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components_by_hand(texts, n=4):
    """Least index of the component of each text, None without words."""
    sets, at = [shingles(t, n) for t in texts], list(range(len(texts)))

    def find(x):
        while at[x] != x:
            x = at[x]
        return x
    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                a, b = find(i), find(j)
                at[max(a, b)] = min(a, b)
    return [find(i) if s else None for i, s in enumerate(sets)]


def near_copies(spark):
    """A base and copies with more and more words changed, long chains included."""
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join(f"x{k}_{i}" if k and i % 120 < k * 2 else w for i, w in enumerate(base)) for k in range(16)]
    texts += [t + " end" for t in texts] + [" ".join(base[:n]) for n in range(60, 120, 6)]
    texts += ["a b", "A B", "a b c", "one", "", None]
    return texts, spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_near_duplicates_equal_all_pairs(spark):
    texts, df = near_copies(spark)
    got = {r.doc_id: r for r in neardup.op5(df).collect()}
    for i, want in enumerate(components_by_hand(texts)):
        assert got[i].n_shingles == len(shingles(texts[i]))
        assert got[i].component_id == (i if want is None else want)
        assert got[i].kept == (want is None or want == i)


def test_remaining_groups_are_checked_by_chunks(spark, monkeypatch):
    monkeypatch.setattr(neardup, "CHUNK", 5)
    texts, df = near_copies(spark)
    got = {r.doc_id: r.component_id for r in neardup.op5(df).collect()}
    assert got == {i: i if c is None else c for i, c in enumerate(components_by_hand(texts))}


def test_near_duplicates_of_documents(spark, docs):
    rows = [r for r in docs.collect() if r.doc_id is not None]
    want = components_by_hand([r.text for r in rows])
    least = {}
    for r, c in zip(rows, want):
        if c is not None:
            least[c] = min(least.get(c, r.doc_id), r.doc_id)
    got = {r.doc_id: r.component_id for r in neardup.op5(docs).collect() if r.doc_id is not None}
    for r, c in zip(rows, want):
        assert got[r.doc_id] == (r.doc_id if c is None else least[c])


def test_odd_sketch_estimates():
    rng = np.random.default_rng(1)
    assert neardup.differing_bits(1.0) == 0
    sets = [rng.integers(0, 1 << 62, 400).astype(np.uint64) for _ in range(2)]
    assert neardup._shared(sets, sets).tolist() == [[400, 0], [0, 400]]


def test_sketch_filter_misses_less_than_the_bands():
    """At similarity 0.8 each sample differs with probability 0.2; one that does flips two random bits."""
    size, samples = neardup.SKETCH_BITS, neardup.SAMPLES
    odd = np.zeros(size + 1)  # probability of so many odd bits
    odd[0] = 1
    at = np.arange(size + 1)
    lost, chance = 0.0, 0.8 ** samples
    for d in range(samples + 1):
        lost += chance * odd[neardup.differing_bits(neardup.ESTIMATE) + 1:].sum()
        chance *= (samples - d) / (d + 1) * 0.25
        for _ in range(2):
            odd = np.concatenate(([0], (odd * (size - at) / size)[:-1])) + np.concatenate(((odd * at / size)[1:], [0]))
    bands = (1 - 0.8 ** neardup.ROWS) ** neardup.BANDS
    assert lost < bands


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 200)]
    got = collections.defaultdict(set)
    for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect():
        got[r.root].add(r.node)
    assert sorted(map(sorted, got.values())) == [list(range(61)), list(range(100, 120))]


def test_stage_keeps_one_of_each_group(spark, docs, clash):
    kept = neardup.stage(clash(docs))
    assert kept.columns == clash(docs).columns
    want = components_by_hand([r.text for r in docs.collect()])
    n = len({c for c in want if c is not None})
    none = docs.where(F.coalesce("text", F.lit("")).rlike(r"^[\x20\x09-\x0D]*$")).count()
    assert kept.count() == n + none


def test_stage_takes_five_words(spark):
    """One middle word differs in texts of 30 to 60 words: some pairs are near on four words only."""
    texts = []
    for n in range(30, 60, 3):
        words = [f"w{n}_{k}" for k in range(n)]
        texts += [" ".join(words), " ".join(words[:n // 2] + ["other"] + words[n // 2 + 1:])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def near(n):
        sets = [shingles(t, n) for t in texts]
        return {b for b in range(1, len(texts), 2)
                if 100 * len(sets[b] & sets[b - 1]) >= 80 * len(sets[b] | sets[b - 1])}
    assert near(5) < near(4)
    assert {r.doc_id for r in neardup.stage(df, 5).collect()} == set(range(len(texts))) - near(5)
    assert {r.doc_id for r in neardup.op5(df).where("kept").collect()} == set(range(len(texts))) - near(4)


def test_word_hashes_are_those_of_the_words():
    texts = [b"a bb  ccc\n", b"", b" \t ", "é A".encode(), b"bb a"]
    h, at = tokens.word_hashes(texts)
    assert np.diff(at).tolist() == [3, 0, 0, 2, 2]
    assert h[0] == h[6] and h[1] == h[5] and len({int(x) for x in h}) == 5
    low, _ = tokens.word_hashes([b"Ab aB ab"], lower=True)
    assert low[0] == low[1] == low[2]
    assert (tokens.windows_hash(h[[0, 1, 2, 0, 1, 2]], 3)[[0]] == tokens.windows_hash(h[[0, 1, 2]], 3)).all()


def remove_by_hand(texts, window=35):
    words = [WORD.findall(t or "") for t in texts]
    seen = collections.Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = {i + k for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for k in range(window)}
        out.append([x for i, x in enumerate(w) if i not in gone])
    return words, out


def test_duplicate_windows_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    passages = [[f"p{p}_{i}" for i in range(n)] for p, n in enumerate((35, 36, 50, 90, 34))]
    texts = []
    for d in range(40):
        w = [f"d{d}_{i}" for i in range(rng.integers(0, 80))]
        for p in rng.integers(0, 5, 2):
            at, cut = rng.integers(0, len(w) + 1), rng.integers(0, 6)
            w[at:at] = passages[p][cut:]
        texts.append(" ".join(w))
    texts += ["r " * 50, "r " * 36, "s " * 35, texts[0], None, ""]
    words, left = remove_by_hand(texts)
    got = {r.doc_id: r for r in substrings.op4(spark.createDataFrame(
        list(enumerate(texts)), "doc_id long, text string")).collect()}
    for i, (w, k) in enumerate(zip(words, left)):
        assert (got[i].n_words, got[i].n_removed) == (len(w), len(w) - len(k))
        assert got[i].kept_sha256 == hashlib.sha256(" ".join(k).encode()).hexdigest()


def test_factors_follow_one_reference():
    hits = [(0, 1, 5), (1, 1, 6), (2, 9, 0), (3, 9, 1), (50, 9, 48)]
    assert substrings.factors(hits) == [(0, 36, 1, 5), (2, 36, 9, 0), (50, 35, 9, 48)]


def test_shards_are_gapless_and_near_equal(spark, docs):
    rows = sharding.op1(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"bytes"}
    by = collections.defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
    assert set(by) <= set(range(24))
    for own in by.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    texts = {(r.doc_id, zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 8)
             for r in docs.collect()}
    assert {(r.doc_id, r.text_crc32, r.size) for r in rows} == texts


def test_tree_reaches_target_bytes(spark):
    df = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"),
        F.when(F.col("id") % 3 > 0, F.lit("en")).alias("lang"),
        F.concat(F.lit("host"), F.col("id") % 7).alias("source"))
    for kw in ({"shards": 5}, {"target_bytes": 20_000}, {"shards": 1}):
        load = {r["_shard"]: r["w"] for r in sharding.shard(df, **kw).groupBy("_shard").agg(
            F.sum("_pt.size").alias("w")).collect()}
        mean = sum(load.values()) / len(load)
        assert max(load.values()) <= 1.02 * mean + 200 and min(load.values()) >= 0.98 * mean - 200
        assert sorted(load) == list(range(len(load)))
        assert "target_bytes" not in kw or mean <= 20_000


def test_stages_keep_columns(spark, docs, clash, sf_dir):
    wide = clash(docs)
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    for out in (quality.stage(wide), decontamination.stage(wide, bench), mixing.stage(wide)):
        assert out.columns == wide.columns
        assert {r[0] for r in out.select("_q").distinct().collect()} == {"mine"}
    assert sorted(sharding.stage(wide).columns) == sorted(wide.columns)
    assert sharding.stage(wide).select("row").distinct().count() == 1


def test_quality_fences_follow_the_group(spark):
    """A source that is all symbols is usual for itself, one such document among prose is not."""
    prose = "some words of plain prose number {0} and a few more to make it {0} long enough here"
    rows = [(i, prose.format(i), "en", "prose") for i in range(150)]
    rows += [(1000 + i, " ".join(f"c{i}_{k} #" for k in range(12)), "en", "code") for i in range(150)]
    rows.append((2000, " ".join(f"z{k} #" for k in range(12)), "en", "prose"))
    rows.append((2001, " ".join(f"z{k} #" for k in range(12)), "xx", "tiny"))
    got = {r.doc_id: r.kept for r in quality.op9(spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(150)) and all(got[1000 + i] for i in range(150))
    assert not got[2000]


def test_sketches_merge_exactly(spark, docs):
    measured = materialise(quality.with_metrics(docs.select("doc_id", "text", "lang", "source")))
    parts = [quality.sketch(measured.where(F.col("doc_id") % 2 == k)) for k in (0, 1)]
    whole = quality.sketch(measured.where("doc_id is not null"))
    by = ["lang", "source"]
    merged = quality.merge_sketches(parts[0].unionByName(parts[1]), by)
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted(
        map(tuple, whole.select(*by, "metric", "bucket", "n").collect()), key=repr)


def test_quotas_are_sainte_lague(spark):
    rows = [("a", 530.0), ("b", 240.0), ("c", 230.0), ("d", 0.0), (None, 1000.0)]
    t = spark.createDataFrame(rows, "source string, target double")
    seats = mixing.quotas(t, block=10, shards=3).collect()
    total = collections.Counter()
    for r in sorted(seats, key=lambda r: r.shard):
        assert r.seats >= 0
        total[r.source] += r.seats
    want = collections.Counter()
    for _ in range(200):
        best = max((x for x in rows if x[1]), key=lambda x: x[1] / (2 * want[x[0]] + 1))
        want[best[0]] += 1
    assert {k: v for k, v in total.items() if v} == dict(want)


def test_quotas_of_many_small_sources(spark):
    import heapq
    small, hot, house = 2000, 1001.0, 10_000
    rows = [(f"s{i:04}", 1.0 + i % 2 * 0.01) for i in range(small)] + [("hot", hot)]
    want = collections.Counter()
    heap = [(-t, s, t) for s, t in rows]
    heapq.heapify(heap)
    for _ in range(house):
        _, s, t = heap[0]
        want[s] += 1
        heapq.heapreplace(heap, (-t / (2 * want[s] + 1), s, t))
    block = sum(t for _, t in rows) / house
    got = mixing.quotas(spark.createDataFrame(rows, "source string, target double"), block=block, shards=1)
    assert {r.source: r.seats for r in got.collect() if r.seats} == dict(want)


def test_targets_are_refilled(spark):
    """Targets stop at three times the size; what is over goes to the others by weight."""
    sizes = [("a", 10), ("b", 1000), ("c", 5), ("d", 300), (None, 40)]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(sizes, "source string, size long")).collect()}
    weight = dict(zip(["a", "b", "c", "d", None], [1, 2, 3, 1, 2]))
    cap, left, open_ = {s: 3 * n for s, n in sizes}, 1355.0, {s for s, _ in sizes}
    want = dict.fromkeys(cap, 0.0)
    while open_ and left > 1e-9:
        level = left / sum(weight[s] for s in open_)
        give = {s: min(level * weight[s], cap[s] - want[s]) for s in open_}
        for s, g in give.items():
            want[s] += g
        left -= sum(give.values())
        open_ = {s for s in open_ if cap[s] - want[s] > 1e-9}
    for s in cap:
        assert got[s] == pytest.approx(want[s])


def test_mixing_of_many_sources_equals_sql(spark, tmp_path):
    import duckdb
    from check import compare
    rng = np.random.default_rng(8)
    rows = [(i, "w " * int(rng.integers(1, 900)), f"s{i % 397:03}") for i in range(1200)] + [(5000 + i, "w " * 3000, "hot") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(spark, con, str(tmp_path), "op10", lambda s, d: mixing.op10(s.read.parquet(f"{d}/documents.parquet")), mixing.SQL) is None


def test_mixing_stays_near_targets(spark, docs):
    rows = mixing.op10(docs).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.taken <= 3 * r["size"] for r in rows)
    taken, target = collections.Counter(), {}
    for r in rows:
        taken[r.source_size, r.target] += r.taken
    for (size, t), n in taken.items():
        assert abs(n - t) <= 2 * mixing.BLOCK
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mixing.op10(docs.repartition(3)).collect()), key=repr)


def test_leaks_with_edits(spark):
    item = " ".join(f"i{k}" for k in range(60))
    near = item.replace("i30 ", "changed ")
    far = " ".join(f"i{k}" if k % 6 else "no" for k in range(60))
    docs = spark.createDataFrame([(1, "x y " + item + " z"), (2, "pre " + near.upper() + " post"), (3, far),
                                  (4, "clean text of no item at all"), (5, None), (6, item[:len(item) // 2])],
                                 "doc_id long, text string")
    bench = spark.createDataFrame([(10, item), (11, None), (12, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.op8(docs, bench).collect()}
    assert set(got) == {(1, 10), (2, 10)} and got[1, 10] == 1.0
    assert {r.doc_id for r in decontamination.stage(docs, bench).collect()} == {3, 4, 5, 6}


def test_equal_texts_come_into_one_shard(spark):
    """Copies differ in language and source; a group of a third of all bytes is cut, others are not."""
    rng = np.random.default_rng(2)
    texts = [f"text {k} " + "x" * int(rng.integers(1, 400)) for k in range(3000)]
    rows = [(i, texts[int(rng.integers(0, 3000)) if i % 3 else 0], f"l{i % 4}", f"s{i % 17}") for i in range(9000)]
    rows += [(9000 + i, "same length %05d" % i, "l1", "s1") for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    at, sizes = collections.defaultdict(set), collections.Counter()
    got = sharding.op1(df).collect()
    for r in got:
        sizes[r["shard"]] += r["size"]
        at[r["doc_id"]] = r["shard"]
    shards = collections.defaultdict(set)
    for i, text, *_ in rows:
        shards[text].add(at[i])
    assert len(got) == 13_000 and {len(v) for k, v in shards.items() if k != texts[0]} == {1}
    assert len(shards[texts[0]]) > 1
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and all(abs(v - mean) < 0.15 * mean for v in sizes.values())


def test_simhash_by_hand(spark):
    rng = np.random.default_rng(5)
    rows = [[int(x) for x in rng.integers(-2**63, 2**63 - 1, n)] for n in (1, 2, 7, 300)]
    df = spark.createDataFrame([(r,) for r in rows], "g array<long>")
    for r, got in zip(rows, df.select("g", decontamination.simhash(F.col("g")).alias("p")).collect()):
        want = sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in got.g) > len(got.g))
        assert got.p % 2**64 == want
    wide = df.select((decontamination._lane_simhash(F.col("g"), 32) == decontamination.simhash(F.col("g"))).alias("same"))
    assert all(r.same for r in wide.collect())
    values = df.select(decontamination.simhash(F.col("g")).alias("p")).select(
        decontamination.block_values(F.col("p")).alias("b")).first().b
    assert len(values) == decontamination.RADIUS + 1
    assert sum((m.bit_length()) for _, m in decontamination.blocks()) == 64


@pytest.mark.parametrize("text", [" ".join(f"w{i * 7919 % 69_997}" for i in range(70_000)), "same " * 33_000])
def test_items_of_any_length_have_a_fingerprint(spark, text):
    bench = spark.createDataFrame([(1, text), (2, " ".join(f"i{k}" for k in range(30)))], "item_id long, text string")
    docs = spark.createDataFrame([(1, "before " + " ".join(f"i{k}" for k in range(30))), (2, "clean")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.op8(docs, bench).collect()] == [(1, 2)]


def test_copies_of_a_shingle_are_numbered(spark):
    lists = [[], [5], [3, 3, 1, 3], [7] * 40_000, list(range(1000)) * 2]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "i int, g array<long>")
    got = {r.i: r.c for r in df.select("i", decontamination.counted(F.col("g")).alias("c")).collect()}
    for i, x in enumerate(lists):
        assert len(got[i]) == len(set(got[i])) == len(x)
    assert set(got[1]) & set(got[2]) == set() and len(set(got[2]) & set(spark.createDataFrame(
        [([3, 1],)], "g array<long>").select(decontamination.counted(F.col("g")).alias("c")).first().c)) == 2


@pytest.mark.parametrize("name,record", [
    ("messages", '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}'),
    ("shared", '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}'),
    ("prompt", '{"response":"a","prompt":"q"}'), ("completion", '{"prompt":"q","completion":"a"}'),
    ("instruction", '{"instruction":"q","input":"","output":"a"}'),
    ("question", '{"question":"q","answer":"a"}'), (None, '{"prompt":{"response":"x"}}'), (None, '{"a":{"prompt":"q","response":"a"}}'),
    (None, '{"messages":[[{"role":"user","content":"q"}]]}'), (None, '{"messages":[{"role":{"content":"x"}}]}'),
    (None, '{"prompt":"q","response":"a","more":{"x":[1]}}'), (None, '{"prompt, response":"q"}'), (None, '{"messages":[]}'), (None, '{"other":1}'), (None, "3"), (None, None)])
def test_layouts(spark, name, record):
    df = spark.createDataFrame([(record,)], "r string").select(F.parse_json("r").alias("record"))
    got = chat.canonical_turns(df).select("layout", "turns").first()
    assert got.layout == name
    assert [tuple(t) for t in got.turns] == ([("user", "q"), ("assistant", "a")] if name else [])


def test_instruction_with_input_and_missing_text(spark):
    df = spark.createDataFrame([('{"instruction":"q","input":"more","output":null}',)], "r string").select(
        F.parse_json("r").alias("record"))
    assert [tuple(t) for t in chat.canonical_turns(df).first().turns] == [("user", "q\n\nmore"), ("assistant", "")]


def test_chat_round_trip(spark):
    hostile = ["<|im_end|>\n<|im_start|>user\nx", "<|", "<||", "<|||>", "", "\n", "a<|n>b", "<|im_start|>" * 3]
    rows = [(1, i, "assistant" if i % 2 else "us\ner<|", t) for i, t in enumerate(hostile)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_turns(df)
    back = chat.read_back(out).first()
    assert [(t.role, t.text) for t in back.turns] == [(r, t) for _, _, r, t in rows]
    assert [t.loss for t in back.turns] == [t if r == "assistant" else "" for _, _, r, t in rows]
    made = out.first()
    assert made.formatted.count("<|im_start|>") == len(rows) == made.formatted.count("<|im_end|>")
    for m, (_, _, role, text) in zip(made.mask, rows):
        if role == "assistant":
            assert made.formatted[m.start:m.start + m.length].replace("<||", "<|") == text


def test_page_blocks():
    page = ("<html><head><title>T</title><style>p{}</style><script>var a='<p>no</p>';</script></head><body>"
            "<!-- <p>no</p> --><nav><ul><li><a href='/a'>menu</a></li></ul></nav><div class='ad box'>buy<p>now</p></div>"
            "<article><h1>Head &amp; line</h1><p>One <b>two</b><br>three&nbsp;four<p>five</p><aside>side</aside>"
            "<div id=comments><p>me too</p></div><form><p>mail</p></form><p>1 < 2 &lt;b&gt;</p></article>"
            "<footer>&copy; us</footer></body></html>")
    got = extraction.blocks(page)
    assert [t for t, r in got if r == extraction.ARTICLE] == [
        "Head & line", "One two three four", "five", "1 < 2 <b>"]
    assert extraction.blocks("") == [] and extraction.blocks("plain") == [("plain", extraction.NEUTRAL)]
    assert extraction.blocks("<p>open <b>never closed") == [("open never closed", extraction.NEUTRAL)]


def test_repeats_on_a_host_go(spark):
    same = "<div>all pages of this host have this long line of words on them</div>"
    page = "<html><body>{}<p>{}</p></body></html>"
    own = {i: " ".join(f"word{i}_{k}" for k in range(9)) for i in (0, 1, 2, 9)}
    rows = [(i, f"http://h.example/{i}", page.format(same, own[i])) for i in range(3)]
    rows += [(9, "http://other.example/", page.format(same, own[9])), (None, None, None), (5, "x", "")]
    got = {r.page_id: r.text for r in extraction.op3(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()}
    for i in range(3):
        assert got[i] == own[i]
    assert got[9].startswith("all pages of this host") and got[None] == "" and got[5] == ""


@pytest.mark.parametrize("held", [0, 200_000])
def test_large_hosts_lose_what_small_ones_lose(spark, held):
    def words(*at):
        return " ".join(f"w{'_'.join(map(str, at))}_{k}" for k in range(12))
    body = "<html><body><div>{}</div><p>{}</p></body></html>"
    rows = [(i, f"http://h.example/{i}", body.format(words("two", i // 2), words("own", i))) for i in range(40)]
    # quoted by one page inside its article: stays on the other
    rows += [(40, "http://h.example/40", body.format(words("quoted"), words("own", 40))),
             (41, "http://h.example/41", f"<article><p>{words('quoted')}</p></article>"),
             (42, "http://h.example/42", "<p>short one</p>"), (43, "http://h.example/43", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for part_bytes in (4 << 20, 400):  # the host in one part; in some twenty slices
        got = {r.page_id: r.text for r in extraction.extract(pages, part_bytes, held).collect()}
        assert got == {i: words("own", i) for i in range(40)} | {
            40: words("quoted") + "\n" + words("own", 40), 41: words("quoted"), 42: "short one", 43: ""}


@pytest.mark.parametrize("held", [0, 200_000])
def test_notices_inside_articles_go(spark, held):
    def words(*at):
        return " ".join(f"w{'_'.join(map(str, at))}_{k}" for k in range(12))
    body = "<main><p>{}</p><div>{}</div></main>"
    rows = [(i, f"http://h.example/{i}", body.format(words("own", i), words("notice"))) for i in range(20)]
    rows += [(20 + i, f"http://h.example/q{i}", body.format(words("own", 20 + i), words("quoted"))) for i in range(4)]
    # too few pages to tell a notice from a quotation
    rows += [(30 + i, f"http://few.example/{i}", body.format(words("own", 30 + i), words("notice"))) for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for part_bytes in (4 << 20, 2000):  # the host in one part; in slices
        got = {r.page_id: r.text for r in extraction.extract(pages, part_bytes, held).collect()}
        assert got == {i: words("own", i) for i in range(20)} | {
            20 + i: words("own", 20 + i) + "\n" + words("quoted") for i in range(4)} | {
            30 + i: words("own", 30 + i) + "\n" + words("notice") for i in range(9)}


def test_repeats_equal_brute_force():
    rng = np.random.default_rng(2)
    tok = rng.integers(0, 3, 900).astype(np.uint64)
    page, host = np.arange(900) // 90, np.arange(900) // 450
    block, region = np.arange(900) // 45, (np.arange(900) // 45) % 2 * 2
    got = extraction.repeated(tok, host, page, block, region, 4)
    where = collections.defaultdict(list)
    for i in range(897):
        if block[i] == block[i + 3]:
            where[host[i], tuple(tok[i:i + 4])].append(i)
    want = np.zeros(900, bool)
    for own in where.values():
        if len({page[i] for i in own}) > 1 and all(region[i] != extraction.ARTICLE for i in own):
            for i in own:
                want[i:i + 4] = True
    assert (got == want).all() and want.any()


def test_articles_come_out_whole(spark):
    import html
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r.text for r in extraction.op3(pages).collect()}
    for p in pages.collect():
        article = re.search(r"<article>(.*?)</article>", p.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert got[p.page_id] == "\n".join(b for b in parts if b)


def test_languages_are_told_apart(spark, docs):
    rows = language.op2(docs).join(docs.where("doc_id < 9000000").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held) > 0
    odd = {r.doc_id: r for r in language.op2(docs).where("doc_id >= 9000000").collect()}
    assert all(odd[9_000_000 + i].lang_pred == "und" and odd[9_000_000 + i].score == 0 for i in (1, 2, 3, 7))
    assert all(0 <= r.score <= 1 for r in odd.values())


def test_language_features():
    letters = language.letter_table()
    assert len(language.features("12 !", letters)[0]) == 0
    a, b = language.features("Ab, cd", letters), language.features("aB 9 CD", letters)
    assert (a[0] == b[0]).all() and (a[1] == b[1]).all() and a[1].sum() == 4 + 6 + 5


def test_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    odd = spark.createDataFrame([(None, None), (9_000_001, ""), (9_000_002, "you idiot, you are a worthless clown")],
                                "doc_id long, text string")
    rows = toxicity.op7(docs.select("doc_id", "text").unionByName(odd), labels).collect()
    score = {r.doc_id: r for r in rows}
    assert len(rows) == docs.count() + 3 and score[9_000_002].predicted == 1
    assert score[None].predicted == score[9_000_001].predicted == 0
    held = [(score[r.doc_id], r.toxic) for r in labels.collect() if score[r.doc_id].held_out]
    assert sum(s.predicted == t for s, t in held) >= 0.93 * len(held)


def test_sample_of_labels_is_bounded_with_copies(spark):
    rows = [(i, "one text" if i % 3 == 0 else f"text {i}", 1) for i in range(3000)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = collections.Counter(r.text == "one text" for r in toxicity.drawn(labelled, 600).collect())
    assert 500 < got.total() < 700 and 140 < got[True] < 260


def test_grammar_tells_kinds_apart():
    machine = toxicity._compose([toxicity.AIMED, toxicity.NEGATED, toxicity.REPORTED])
    lex = {"idiot": 1.0}

    def kinds(text):
        return set(np.flatnonzero(toxicity.match_kinds(text, lex, machine)[:toxicity.KINDS]))
    assert kinds("idiot") == {0} and kinds("you idiot") == {1} and kinds("not an idiot") == {2}
    assert kinds("she said he is an idiot") == {5} and kinds("not you. idiot") == {0}
    assert kinds("i will kill you") == {8} and kinds("you: kill") == {8} and kinds("a clean text") == set()
    assert toxicity._entry("idiots", {"idio*": 2.0}) == 2.0


def test_pipeline_stages(spark, sf_dir):
    import corpus_pipeline as P
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, at = docs.columns, {}
    for name, stage in P.STAGES:
        before, docs = docs, materialise(stage(spark, docs, sf_dir))
        at[name] = (before, docs)
        assert docs.columns == (columns if name != "sharding" else columns + ["shard"])
    before, after = at["quality_rules"]
    judged = quality.op9(before)
    assert after.count() == judged.where("kept").count()
    before, after = at["near_duplicates"]
    parts = components_by_hand([r.text for r in before.collect()], 5)
    assert after.count() == len(set(parts)) and None not in parts
    before, after = at["decontamination"]
    bad = decontamination.op8(before, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - {r.doc_id for r in bad.collect()}
    before, after = at["mixing"]
    times = collections.Counter(r.doc_id for r in after.collect())
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in before.collect()}
    before, after = at["sharding"]
    assert after.drop("shard").exceptAll(before).isEmpty() and after.count() == before.count()
    assert P.run(spark, sf_dir).count() == after.count()
