"""Main text of web pages, with a suffix array over the pages of a host.

A page is cut into blocks at block-level tags.  Each block has a region: navigation, advert, form and the
like (by tag, role, class or id), the article, or neither.  The token streams of the pages of a host are
concatenated; a suffix array of them, sorted to ``REPEAT`` tokens, shows every run of that many tokens that
stands on two pages or more.  Such a run is boilerplate unless one of these pages has it inside an article:
articles quote each other, and adverts quote articles, so that what an article says stays.  A run that NOTICE_SHARE
per cent of the pages with an article, NOTICE_PAGES at least, have inside it is no quotation but a notice of the
host, and is boilerplate too.  Boilerplate tokens go, blocks of the first kind go, and of the rest the article is kept, or everything where a page marks none.

What a run is worth is decided from all pages of its host, whatever its size.  Page texts are dealt out by host
and, for a host with more text than one task should hold, by a hash of the page; the suffix array of a part
decides the runs of the hosts that lie whole in it.  For the other hosts the pages of every run that could go are
counted over the whole host.  The runs that go are then taken out of the pages, which are read once more.
"""

from __future__ import annotations

import hashlib
import html as entities
import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortry.operators import materialise

from .common import lookup_join, small
from .tokens import mix, windows_hash, word_hashes

REPEAT = 8
PART_BYTES = 4 << 20
#: Pages that must have a run inside the article, and their share of the host's pages with an article.
NOTICE_PAGES, NOTICE_SHARE = 10, 80
#: Runs that tasks hold as a set; beyond that they are joined to the pages.
HELD_RUNS = 200_000

# What HTML's elements mean.
RAW = "script|style|noscript|template|svg|iframe|textarea|title"
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(" + RAW + r")\b[^>]*>.*?(?:</\1\s*>|\Z)"
                   r"|<(/?)([a-zA-Z][a-zA-Z0-9-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>",
                   re.S | re.I)
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt "
             "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
NOISE_TAGS = set("nav header footer aside form button select option menu dialog head fieldset".split())
MAIN_TAGS = {"article", "main"}
NOISE_NAMES = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment "
                  "comments consent contentinfo cookie cookies disqus footer header menu menubar nav navbar "
                  "navigation newsletter notice notices notification pagination pager popup promo promoted "
                  "promotion related respond search share sharing sidebar signup social sponsor sponsored "
                  "subscribe toolbar widget complementary alert".split())
NAMED = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
NOISE, NEUTRAL, ARTICLE = 0, 1, 2


def _noisy(name: str, attributes: str) -> bool:
    if name in NOISE_TAGS:
        return True
    for value in NAMED.findall(attributes):
        if not NOISE_NAMES.isdisjoint(re.split(r"[^a-z]+", value.lower())):
            return True
    return False


def blocks(page: str) -> list[tuple[str, int]]:
    """Text and region of each block in page order; references decoded, white space single."""
    out: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements that are not inline, with the region inside

    def region() -> int:
        return stack[-1][1] if stack else NEUTRAL

    def flush() -> None:
        text = " ".join(entities.unescape("".join(held)).split())
        if text:
            out.append((text, region()))
        held.clear()
    at = 0
    for m in TOKEN.finditer(page):
        held.append(page[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if m[1]:
            continue  # raw text is not content
        if not name:
            continue
        noisy = not m[2] and _noisy(name, m[4])
        if name in INLINE and not noisy and not (m[2] and any(n == name for n, _ in stack)):
            if name == "br":
                held.append(" ")
            continue
        flush()
        if m[2]:
            if any(n == name for n, _ in stack):
                while stack.pop()[0] != name:
                    pass
        else:
            if stack and stack[-1][0] in ("p", "li", "dt", "dd", "td", "th", "tr", "option"):
                if name == stack[-1][0] or stack[-1][0] == "p":
                    stack.pop()
            if name not in VOID and not m[4].rstrip().endswith("/"):
                inside = NOISE if noisy or region() == NOISE else \
                    ARTICLE if name in MAIN_TAGS else region()
                stack.append((name, inside))
    held.append(page[at:])
    flush()
    return out


def runs(tokens: np.ndarray, host: np.ndarray, page: np.ndarray, block: np.ndarray, region: np.ndarray,
         length: int = REPEAT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array of the concatenated streams and the number of each suffix's run; and of each run the
    pages that have it and those that have it inside an article.  The arrays give hash, host, page, block and
    region of each token; a run must lie within one block."""
    n = len(tokens)
    if n < length:
        return (np.zeros(0, dtype=np.int64),) * 4
    # ranks of the suffixes by their first token, then by 2, 4, ... tokens: prefix doubling
    rank = np.unique(tokens ^ (host.astype(np.uint64) << np.uint64(40)), return_inverse=True)[1]
    depth = 1
    while depth < length:
        step = min(depth, length - depth)
        follow = np.concatenate((rank[step:], np.full(step, -1)))
        rank = np.unique(rank.astype(np.int64) * (n + 1) + follow + 1, return_inverse=True)[1]
        depth += step
    suffixes = _starts(block, length)
    outside = region[suffixes] != ARTICLE
    order = suffixes[np.lexsort((outside, page[suffixes], rank[suffixes]))]  # the suffix array
    r, p = rank[order], page[order]
    new_run = np.concatenate(([True], r[1:] != r[:-1]))[:len(r)]
    new_page = new_run | np.concatenate(([True], p[1:] != p[:-1]))[:len(r)]
    run = np.cumsum(new_run) - 1
    pages = np.bincount(run, weights=new_page).astype(np.int64)
    inside = np.bincount(run, weights=new_page & (region[order] == ARTICLE)).astype(np.int64)
    return order, run, pages, inside


def _starts(block: np.ndarray, length: int = REPEAT) -> np.ndarray:
    """Where a run within one block begins."""
    return np.flatnonzero(block[:max(0, len(block) - length + 1)] == block[length - 1:])


def _cover(starts: np.ndarray, n: int, length: int = REPEAT) -> np.ndarray:
    """Which of ``n`` tokens lie in a run that begins at one of ``starts``."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return np.cumsum(edge[:-1]) > 0


def _goes(pages, inside, marked):
    """Whether a run is boilerplate, from the pages of its host that have it, that have it inside an article,
    and that mark an article."""
    return ((pages >= 2) & (inside == 0)) | ((inside >= NOTICE_PAGES) & _mostly(inside, marked))


def _mostly(inside, marked):
    return 100 * inside >= NOTICE_SHARE * marked


def _per_run(order: np.ndarray, run: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The value of each run from those of the tokens."""
    return values[order[np.flatnonzero(np.diff(run, prepend=-1))]]


def repeated(tokens: np.ndarray, host: np.ndarray, page: np.ndarray, block: np.ndarray, region: np.ndarray,
             length: int = REPEAT) -> np.ndarray:
    """Which tokens lie in a boilerplate run, where the arrays hold whole hosts; see :func:`runs`."""
    order, run, pages, inside = runs(tokens, host, page, block, region, length)
    own = np.unique(np.stack((host, page))[:, region == ARTICLE], axis=1)[0]
    marked = _per_run(order, run, np.bincount(own, minlength=host.max(initial=0) + 1)[host])
    return _cover(order[_goes(pages, inside, marked)[run]], len(tokens), length)


def _host_key(host: str | None) -> int:
    return int.from_bytes(hashlib.blake2b((host or "").encode(), digest_size=8).digest(), "little", signed=True)


class _Stream:
    """The blocks of several pages as one stream of tokens; ``use`` marks those whose text can come out."""

    def __init__(self, pages: list[list[tuple[str, int]]], hosts: list[int]):
        self.flat = [(i, text, region) for i, own in enumerate(pages) for text, region in own]
        self.tokens, self.at = word_hashes([text.encode() for _, text, _ in self.flat])
        size = np.diff(self.at)
        of = np.array([i for i, _, _ in self.flat], dtype=np.int64)
        kind = np.array([r for _, _, r in self.flat], dtype=np.int64)
        self.marked = np.zeros(len(pages), dtype=bool)
        self.marked[of[kind == ARTICLE]] = True
        self.page, self.region = np.repeat(of, size), np.repeat(kind, size)
        self.block = np.repeat(np.arange(len(self.flat)), size)
        self.used = np.where(self.marked[of], kind == ARTICLE, kind == NEUTRAL)
        self.use = np.repeat(self.used, size)
        self.hosts = np.array(hosts, dtype=np.int64)

    def keys(self, at: np.ndarray) -> np.ndarray:
        """A hash of host and tokens of the runs that begin at ``at``."""
        if not len(at):
            return np.zeros(0, dtype=np.int64)
        host = mix(self.hosts[self.page[at]].view(np.uint64))
        return mix(windows_hash(self.tokens, REPEAT)[at] ^ host).view(np.int64)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            part = batch.slice(lo, 256)
            pages = [blocks(h.as_py() or "") for h in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("_part"), part.column("_whole"),
                 pa.array([_host_key(h.as_py()) for h in part.column("host")], pa.int64()),
                 pa.array([[t for t, _ in own] for own in pages], pa.list_(pa.string())),
                 pa.array([[r for _, r in own] for own in pages], pa.list_(pa.int32()))],
                names=["_part", "whole", "host", "texts", "regions"])


def _judge(table: pa.Table) -> pa.Table:
    """Of the hosts that lie whole in a part the runs that go.  Of every other host its runs that are notices by
    the pages of this part, for a notice of the host is one in some part; and a row without a run, with the
    pages that mark an article and those that mark none."""
    pages = [list(zip(t.as_py(), r.as_py())) for t, r in zip(table.column("texts"), table.column("regions"))]
    own = _Stream(pages, table.column("host").to_pylist())
    whole = np.array(table.column("whole").to_pylist(), dtype=bool)
    names, host = np.unique(own.hosts, return_inverse=True)
    marked = np.bincount(host, weights=own.marked, minlength=len(names)).astype(np.int64)
    unmarked = np.bincount(host, weights=~own.marked, minlength=len(names)).astype(np.int64)
    order, run, n, inside = runs(own.tokens, host[own.page], own.page, own.block, own.region)
    of = _per_run(order, run, marked[host][own.page])
    mine = whole[own.page[order]]
    gone = np.unique(own.keys(order[mine & own.use[order] & _goes(n, inside, of)[run]]))
    some = order[~mine & ((inside > 0) & _mostly(inside, of))[run]]
    maybe, first = np.unique(own.keys(some), return_index=True)
    rest = np.flatnonzero(np.bincount(host, weights=~whole, minlength=len(names)))

    def rows(*parts):
        return pa.array([x for part in parts for x in part], pa.int64())
    less, none = [None] * len(gone), [None] * len(maybe)
    return pa.table({"run": rows(gone.tolist(), maybe.tolist(), [None] * len(rest)),
                     "host": rows(less, own.hosts[own.page[some[first]]].tolist(), names[rest].tolist()),
                     "marked": rows(less, none, marked[rest].tolist()),
                     "unmarked": rows(less, none, unmarked[rest].tolist())})


def _streams(batches: Iterator[pa.RecordBatch], wanted: Callable[[int], bool] = lambda host: True
             ) -> Iterator[tuple[pa.RecordBatch, _Stream]]:
    """Slices of the batches and their pages' streams; pages of hosts that are not wanted are left out."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 64):
            part = batch.slice(lo, 64)
            hosts = [_host_key(h.as_py()) for h in part.column("host")]
            part = part.filter(pa.array([wanted(h) for h in hosts], pa.bool_()))
            if part.num_rows:
                yield part, _Stream([blocks(h.as_py() or "") for h in part.column("html")],
                                    [h for h in hosts if wanted(h)])


def _page_runs(whole: frozenset[int], some: frozenset[int], maybe: np.ndarray):
    """Every run of each page of the hosts in ``whole``, and those in ``maybe`` of the hosts in ``some``, once a
    page: whether the page has it inside an article, and whether where its text can come out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.array(sorted(whole), dtype=np.int64)
        for _, own in _streams(batches, lambda host: host in whole or host in some):
            at = _starts(own.block)
            keys = own.keys(at)
            wanted = np.isin(keys, maybe) | np.isin(own.hosts[own.page[at]], every)
            at, keys = at[wanted], keys[wanted]
            order = np.lexsort((keys, own.page[at]))
            at, keys = at[order], keys[order]
            page = own.page[at]
            first = np.flatnonzero(np.concatenate(
                ([True], (keys[1:] != keys[:-1]) | (page[1:] != page[:-1])))[:len(at)])
            if len(first):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[first]), pa.array(own.hosts[page[first]]),
                     pa.array(np.logical_or.reduceat(own.region[at] == ARTICLE, first).astype(np.int64)),
                     pa.array(np.logical_or.reduceat(own.use[at], first))],
                    names=["run", "host", "inside", "use"])
    return run


def _used_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``page, run`` of the runs of each page that lie where its text can come out."""
    for part, own in _streams(batches):
        at = _starts(own.block)
        at = at[own.use[at]]
        key = part.column("page").to_numpy()[own.page[at]]
        yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(own.keys(at))], names=["page", "run"])


def _texts(gone: np.ndarray | None):
    """Main text of each page without the runs in ``gone``, or where this is None in the row's own ``gone``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, own in _streams(batches):
            at = _starts(own.block)
            at = at[own.use[at]]
            keys = own.keys(at)
            if gone is not None:
                bad = np.isin(keys, gone)
            else:
                sets = [set(x.as_py() or ()) for x in part.column("gone")]
                bad = np.array([k in sets[p] for k, p in zip(keys.tolist(), own.page[at].tolist())], dtype=bool)
            covered = _cover(at[bad], len(own.tokens))
            kept: list[list[str]] = [[] for _ in range(part.num_rows)]
            for (i, text, _), used, lo, hi in zip(own.flat, own.used, own.at[:-1], own.at[1:]):
                if not used:
                    continue
                if covered[lo:hi].any():
                    text = " ".join(w for w, g in zip(text.split(" "), covered[lo:hi]) if not g)
                if text:
                    kept[i].append(text)
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(["\n".join(k) for k in kept], pa.string())],
                names=["page_id", "url", "text"])
    return run


def host_of(url: Column) -> Column:
    """Host of an absolute address, lower case; empty where there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1))


def boilerplate(own: DataFrame, part_bytes: int = PART_BYTES, held_runs: int = HELD_RUNS) -> DataFrame:
    """``run``: keys of the runs that go, from all pages of each host."""
    weight = F.coalesce(F.octet_length("html"), F.lit(0)) + 64
    load = own.groupBy("host").agg(F.sum(weight).alias("w"))
    total = load.agg(F.sum("w")).first()[0] or 0
    parts = max(1, math.ceil(total / part_bytes))
    slices = load.select("host", F.ceil(F.col("w") / part_bytes).alias("_slices"))
    dealt = lookup_join(own, slices, ["host"], 100_000).withColumn(
        "_slice", F.pmod(F.xxhash64("page_id", "url", "html"), F.col("_slices")))
    part = F.pmod(F.xxhash64("host") + F.col("_slice") % 1_000_003, F.lit(parts))
    found = materialise(dealt.select(part.alias("_part"), (F.col("_slices") == 1).alias("_whole"), "html", "host")
                        .mapInArrow(_parse, "_part long, whole boolean, host long, texts array<string>, "
                                    "regions array<int>")
                        .groupBy("_part").applyInArrow(_judge, "run long, host long, marked long, unmarked long"))
    gone = found.where("run is not null and host is null").select("run")
    # the hosts of several slices: at most total / part_bytes of them.  Where all pages mark an article only notices
    # can go, which are few: more than held_runs are counted as all runs of their hosts
    hosts = materialise(found.where("run is null").groupBy("host").agg(
        F.sum("marked").alias("marked"), F.sum("unmarked").alias("unmarked")))
    whole = frozenset(r["host"] for r in hosts.where("unmarked > 0").select("host").collect())
    notices = found.where("run is not null and host is not null").select("run", "host").distinct()
    some = frozenset(r["host"] for r in notices.select("host").distinct().collect())
    if small(notices, held_runs):
        maybe = np.array([r["run"] for r in notices.select("run").collect()], dtype=np.int64)
    else:
        maybe, whole = np.zeros(0, dtype=np.int64), whole | some
    if whole or some:
        counted = own.mapInArrow(_page_runs(whole, some, maybe),
                                 "run long, host long, inside long, use boolean").groupBy("run").agg(
            F.min("host").alias("host"), F.count("*").alias("pages"), F.sum("inside").alias("inside"),
            F.max("use").alias("use"))
        known = lookup_join(counted, hosts.select("host", "marked"), ["host"], 100_000)
        gone = gone.union(known.where(F.col("use") & _goes(F.col("pages"), F.col("inside"), F.col("marked")))
                          .select("run"))
    return materialise(gone)


def extract(pages: DataFrame, part_bytes: int = PART_BYTES, held_runs: int = HELD_RUNS) -> DataFrame:
    """``page_id, url, text`` of every row of ``pages``.

    NULL or empty ``html`` gives an empty text; pages without a host are a host of their own kind; rows
    with equal ids are pages of their own.  Pages are grouped to parts of about ``part_bytes`` of html; a
    part holds several small hosts, or a slice of a large one.  Neither this nor ``held_runs``, the most
    runs that a task holds, changes a text.
    """
    own = pages.select("page_id", "url", "html", host_of(F.col("url")).alias("host"))
    gone, schema = boilerplate(own, part_bytes, held_runs), "page_id long, url string, text string"
    if small(gone, held_runs):
        held = np.array([r["run"] for r in gone.collect()], dtype=np.int64)
        return own.mapInArrow(_texts(held), schema)
    # rows that are equal in all columns have equal runs
    keyed = own.withColumn("page", F.xxhash64("page_id", "url", "html"))
    marks = gone.select("run", F.lit(True).alias("bad"))
    hits = lookup_join(keyed.mapInArrow(_used_runs, "page long, run long").distinct(), marks, ["run"],
                       held_runs).where("bad").groupBy("page").agg(F.collect_set("run").alias("gone"))
    return keyed.join(hits, "page", "left").mapInArrow(_texts(None), schema)


def op3(pages: DataFrame) -> DataFrame:
    """Main text of each page, in the columns of the contract."""
    return extract(pages).withColumn("n_chars", F.length("text").cast("long"))
