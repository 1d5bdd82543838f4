"""Main text of web pages by template deduction over the pages of a host.

Tokens are tags in their place (the path of containers around them) and whole
text blocks in theirs.  Tokens of a host that occur equally often on each of
its pages, ``PAGES`` different ones at least, form an equivalence class.  A class is
valid as far as it is ordered, its members in a container follow each other as they do
in most places, and nested, all that is around it is valid too: the fewest tags that
break the order are taken out of their class, and of the template with all that lies
in them.  Of what is left, a class of ``CLASS_SIZE`` tags or more is a root of the
host's template; the classes that lie in its containers are nested in it, whatever
their size: the classes of sections that some pages have.  A text
block that has its container's vector belongs to the container's class: it is
there, and the same, wherever the container is.  A container of the template all of
whose own text is such is a constant part of it, any other one is a slot.

A page's main text is the text of its slots in page order, without parts that are
marked as something else.  Where slots lie in elements that are marked as an article
(``article`` or ``main``), these slots are the article's: the other slots go, and so do
marked elements that are constant, such as a teaser that all pages have; what is
constant inside the elements with slots is part of the article and stays.

Occurrence vectors are never gathered: a vector's hash is the exclusive or of
a hash per page and count, summed up before and after the shuffle, so a host
with a third of all pages costs what its distinct tokens do.

Defined cases: a null or empty page has the empty text; a null or broken url is
a host of its own kind, the empty one; copies of a page are one page for the
support of a class; a page of a host without template is read by its own markup;
if constants are all a page has, they are its text; equal rows give equal
results; other columns are dropped, whatever their names; an empty table gives
an empty table; where all marked elements are constant (copies of one article), they
are the text, not the slots around them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from xxhash import xxh64_intdigest

from ledgerloom.llm.arrow import map_arrow, slices, texts_of
from ledgerloom.llm.html_blocks import Block, Page, read
from ledgerloom.sources.scratch import Scratch

PAGES = 2
CLASS_SIZE = 3
TAG, TEXT = 0, 1


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def _tokens(pages: DataFrame) -> DataFrame:
    """Rows per host and token, a tag's being its parent: pages with it, vector hash,
    least and greatest hash of these pages' content."""

    def run(batches):
        for batch in slices(batches, "html"):
            found: dict = {}
            names = batch.column("page").to_pylist()
            hosts = batch.column("host").to_pylist()
            contents = batch.column("content").to_pylist()
            for host, name, content, html in zip(hosts, names, contents, texts_of(batch, "html"), strict=True):
                page = read(html)
                count = Counter((TAG, path, parent) for path, parent in zip(page.tags, page.parents, strict=True))
                count.update(
                    (TEXT, b.path, xxh64_intdigest(b.text.encode())) for b in page.blocks if not b.left_out
                )
                for key, n in count.items():
                    row = found.setdefault((host, *key), [0, 0, content, content])
                    row[0] += 1
                    row[1] ^= xxh64_intdigest(n.to_bytes(8, "little"), name & (1 << 64) - 1)
                    row[2], row[3] = min(row[2], content), max(row[3], content)
            keys, rows = list(found), list(found.values())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in keys], pa.string()),
                    pa.array([k[1] for k in keys], pa.int32()),
                    pa.array([_signed(k[2]) for k in keys], pa.int64()),
                    pa.array([_signed(k[3]) for k in keys], pa.int64()),
                    pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([_signed(r[1]) for r in rows], pa.int64()),
                    pa.array([r[2] for r in rows], pa.int64()),
                    pa.array([r[3] for r in rows], pa.int64()),
                ],
                names=["host", "kind", "path", "token", "pages", "vector", "low", "high"],
            )

    made = map_arrow(
        pages,
        run,
        "host string, kind int, path long, token long, pages long, vector long, low long, high long",
    )
    return made.groupBy("host", "kind", "path", "token").agg(
        F.sum("pages").alias("pages"),
        F.bit_xor("vector").alias("vector"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
    )


def orders(page: Page, classes: Mapping[int, int]) -> Iterator[tuple[int, int, tuple[int, ...]]]:
    """Each occurrence of a class in a container: the container, the class, and those of
    its members in page order.

    A class occurs anew with a tag that its present occurrence has already, and with
    each container.
    """
    inside: dict[int, dict[int, dict[int, None]]] = {}
    for path, parent in zip(page.tags, page.parents, strict=True):
        own = classes.get(path)
        if own is None:
            continue
        for ended, members in inside.pop(path, {}).items():
            yield path, ended, tuple(members)
        around = inside.setdefault(parent, {})
        members = around.setdefault(own, {})
        if path in members:
            yield parent, own, tuple(members)
            members = around[own] = {}
        members[path] = None
    for parent, around in inside.items():
        for own, members in around.items():
            yield parent, own, tuple(members)


def out_of_order(members: Sequence[int], reference: Sequence[int]) -> list[int]:
    """The fewest of ``members`` without which the others stand as in ``reference``."""
    place = {member: i for i, member in enumerate(reference)}
    ranks = [place[m] for m in members if m in place]
    ends: list[int] = []  # least last rank of an ordered part, by its length
    at: list[int] = []  # and the place in ``ranks`` that has it
    before: list[int] = []
    for i, rank in enumerate(ranks):
        length = bisect_left(ends, rank)
        before.append(at[length - 1] if length else -1)
        ends[length : length + 1] = [rank]
        at[length : length + 1] = [i]
    kept, i = set(), at[-1] if at else -1
    while i >= 0:
        kept.add(ranks[i])
        i = before[i]
    return [reference[rank] for rank in ranks if rank not in kept]


def _displaced(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per host with tags out of order, of those in ``paths``: members of a class
    that stand elsewhere among the others than on most pages."""

    def run(batches):
        for batch in slices(batches, "html"):
            found: Counter = Counter()
            known: dict = {}
            paths, classes = batch.column("paths"), batch.column("classes")
            for i, (host, html) in enumerate(
                zip(batch.column("host").to_pylist(), texts_of(batch, "html"), strict=True)
            ):
                if host not in known:
                    known[host] = {
                        p & (1 << 64) - 1: c for p, c in zip(paths[i].as_py(), classes[i].as_py(), strict=True)
                    }
                found.update((host, *o) for o in orders(read(html), known[host]) if len(o[2]) > 1)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in found], pa.string()),
                    pa.array([_signed(k[1]) for k in found], pa.int64()),
                    pa.array([k[2] for k in found], pa.int64()),
                    pa.array([[_signed(m) for m in k[3]] for k in found], pa.list_(pa.int64())),
                    pa.array(list(found.values()), pa.int64()),
                ],
                names=["host", "parent", "class", "members", "n"],
            )

    def compare(batches):
        for batch in batches:
            hosts, found = batch.column("host").to_pylist(), set()
            for i, host in enumerate(hosts):
                members, reference = (batch.column(c)[i].as_py() for c in ("members", "reference"))
                found.update((host, path) for path in out_of_order(members, reference))
            yield pa.RecordBatch.from_arrays(
                [pa.array([h for h, _ in found], pa.string()), pa.array([p for _, p in found], pa.int64())],
                names=["host", "path"],
            )

    kinds = "host string, parent long, class long, members array<long>, n long"
    keys = ["host", "parent", "class"]
    found = map_arrow(pages, run, kinds).groupBy(*keys, "members").agg(F.sum("n").alias("n"))
    found = scratch.stage(found, "orders")
    usual = (
        found.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("orders"), F.max(F.struct("n", "members")).alias("most"))
        .where(F.col("orders") > 1)
        .select(*keys, F.col("most.members").alias("reference"))
    )
    pairs = found.join(usual, keys).select("host", "members", "reference")
    return (
        map_arrow(pairs, compare, "host string, path long")
        .distinct()
        .groupBy("host")
        .agg(F.collect_list("path").alias("displaced"))
    )


def nested(
    paths: Sequence[int], parents: Sequence[int], classes: Sequence[int], displaced: Sequence[int]
) -> set[int]:
    """The tags of the template: those in order, and all around them, that are of a root
    class or lie in one."""
    around, own, out = dict(zip(paths, parents, strict=True)), dict(zip(paths, classes, strict=True)), set(displaced)

    def spread(holds: dict[int, bool], ends) -> dict[int, bool]:
        """For every tag what ``ends`` says of it, or else what holds for its parent."""
        for path in paths:
            chain = []
            while path not in holds:
                if path not in around or (known := ends(path)) is not None:
                    holds[path] = path in around and known
                    break
                chain.append(path)
                path = around[path]
            holds.update(dict.fromkeys(chain, holds[path]))
        return holds

    # 0 is around all
    placed = spread({0: True}, lambda path: False if path in out else None)
    size = Counter(own[path] for path in paths if placed[path])
    roots = {c for c, members in size.items() if members >= CLASS_SIZE}
    rooted = spread({0: False}, lambda path: True if own[path] in roots else None)
    return {path for path in paths if placed[path] and rooted[path]}


def template(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """A row per host with a template: ``constants``, the paths of the containers
    whose own text is constant; all others are slots."""
    tokens = scratch.stage(_tokens(pages), "tokens")
    supported = tokens.where((F.col("pages") >= PAGES) & (F.col("low") < F.col("high")))
    tags = supported.where(F.col("kind") == TAG).select(
        "host", "path", F.col("token").alias("parent"), "pages", "vector", F.xxhash64("pages", "vector").alias("class")
    )
    # whatever its order, a root class has so many members
    large = (
        tags.groupBy("host", "class")
        .agg(F.count(F.lit(1)).alias("members"))
        .where(F.col("members") >= CLASS_SIZE)
        .select("host")
        .distinct()
    )
    containers = tags.select(
        "host", "path", F.col("pages").alias("__pages"), F.col("vector").alias("__vector")
    )
    same = (F.col("pages") == F.col("__pages")) & (F.col("vector") == F.col("__vector"))
    # text of its container's class
    constant = (
        tokens.where(F.col("kind") == TEXT)
        .join(containers, ["host", "path"])
        .groupBy("host", "path")
        .agg(F.bool_and(same).alias("constant"))
        .where("constant")
        .groupBy("host")
        .agg(F.collect_list("path").alias("constant"))
    )
    # distinct tags of a host that two of its pages have; of use only where text may go
    classes = (
        tags.join(large, "host", "left_semi")
        .groupBy("host")
        .agg(F.collect_list(F.struct("path", "parent", "class")).alias("tags"))
        .join(constant, "host")
        .select(
            "host",
            "constant",
            *[F.col(f"tags.{c}").alias(name) for c, name in (("path", "paths"), ("parent", "parents"), ("class", "classes"))],
        )
    )
    classes = scratch.stage(classes, "classes")
    there = pages.join(classes.select("host", "paths", "classes"), "host")
    displaced = _displaced(there.select("host", "html", "paths", "classes"), scratch)
    none = F.array().cast("array<bigint>")

    def nest(batches):
        for batch in batches:
            names = ("paths", "parents", "classes", "displaced", "constant")
            constants = []
            for i in range(batch.num_rows):
                *found, constant = (batch.column(name)[i].as_py() for name in names)
                constants.append(sorted(nested(*found).intersection(constant)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("host"), pa.array(constants, pa.list_(pa.int64()))], names=["host", "constants"]
            )

    found = classes.join(displaced, "host", "left").withColumn("displaced", F.coalesce("displaced", none))
    return map_arrow(found, nest, "host string, constants array<bigint>")


def main_blocks(page: Page, constants: frozenset[int]) -> list[Block]:
    """The page's blocks of its slots; with slots in marked articles, those of these."""
    shown = [b for b in page.blocks if not b.left_out]
    slots = [b for b in shown if _signed(b.path) not in constants]
    # without a slot inside, all marked articles count: the page is a copy in its frame
    articles = {b.article for b in slots if b.article} or {b.article for b in shown if b.article}
    return [b for b in shown if b.article in articles] or slots or shown


def extract(pages: DataFrame, scratch: Scratch) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every page."""
    rows = pages.select(
        "page_id", "url", "html", host_of(F.col("url")).alias("host"),
        F.xxhash64("page_id", "url").alias("page"), F.xxhash64("html").alias("content"),
    )
    known = scratch.stage(template(rows.select("host", "page", "content", "html"), scratch), "templates")

    def run(batches):
        for batch in slices(batches, "html"):
            texts = []
            sets: dict = {}
            lists = batch.column("constants")
            hosts = batch.column("host").to_pylist()
            for i, html in enumerate(texts_of(batch, "html")):
                if hosts[i] not in sets:
                    sets[hosts[i]] = frozenset(lists[i].as_py() or ())
                blocks = main_blocks(read(html), sets[hosts[i]]) if html else []
                texts.append(" ".join(b.text for b in blocks))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    kinds = T.StructType(
        [rows.schema["page_id"], rows.schema["url"], T.StructField("text", T.StringType())]
    )
    joined = rows.join(known, "host", "left")
    return map_arrow(joined.select("page_id", "url", "html", "host", "constants"), run, kinds)
