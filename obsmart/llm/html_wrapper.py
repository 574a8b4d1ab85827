"""Main text of pages by wrapper induction.

Pages of a host share templates. Each page becomes a tree of blocks; its
shape is the tree with runs of equal parts folded. The host's most common
shape is its wrapper, and every page's shape is aligned with it by simple tree
matching. Over all different pages of the host (copies count once), a node of
the wrapper whose text is the same nearly everywhere is template: where a page
has that very text there, it is no content. The other text nodes are slots,
which weigh as much as the text outside links that all pages have there. The
heaviest slot's element, with those around it as long as they bring much more
text, is the host's content, as are level 1 headings above it; a content inside
an article or main element is that whole element, its constant texts included.

A page's main text is what its nodes that match the content hold, less template
texts. Only where a host has too few different pages for a wrapper, or a page
has nothing there (it follows another template), do tags decide: what an
article or main element holds, or, without these, all text that is no template
and no list of links. Elements that HTML or a class names as menus, headers,
footers, sidebars, notices, adverts, forms, scripts or comments never count,
for their text varies, too; ``lists=False`` switches that off.

Every page takes part in the statistics. What is shuffled for them are shapes and
hashes of texts, one row for all copies in a task, then hashes combined by (host, node, hash) before and by (host, node) after; the
wrappers (one row a host, as long as one page's shape) are joined to the pages and
broadcast by Spark only where their stored size allows, else the join may split a heavy host.

Cases: a null or empty html has an empty text; a null url or one without a
host belongs to the host ""; of equally common shapes the greater text is the
wrapper, of equally heavy slots the first; where all of a page's text is
template, all of it is kept; a very long page is read whole, its lists of
thousands of different parts are matched by parts found once in both and by
label; repeated rows are extracted alike; an empty table gives no rows; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsmart.llm.common import ship_code, stage, table
from obsmart.llm.page_tree import HEADINGS, Shape, from_text, matched_texts, shaped, size, to_text, tree

#: Different pages of a host with a node at least, and the share of them with one
#: and the same text there, for that text to be template.
LEAST_PAGES, CONSTANT = 4, 0.8
#: Text that elements around the content must bring, of what it has, to belong to it.
GAIN = 0.25
#: Without a wrapper: share of a node's characters in links from which it is a list of links.
LINKED = 0.9


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.coalesce(found, F.lit("")))


def text_hashes(blocks: list[tuple[int, str, bool, int]]) -> dict[int, int]:
    """The hash of a page's text at each of its nodes that hold text."""
    texts: dict[int, list[str]] = {}
    for node, text, _, _ in blocks:
        texts.setdefault(node, []).append(text)
    return {node: xxhash.xxh64_intdigest("\n".join(t)) - (1 << 63) for node, t in texts.items()}


def free_text(blocks: list[tuple[int, str, bool, int]]) -> dict[int, int]:
    """Characters outside links at each of a page's nodes that hold text."""
    found: dict[int, int] = {}
    for node, text, _, links in blocks:
        found[node] = found.get(node, 0) + max(0, len(text) - links)
    return found


def _parsed(pages: DataFrame, lists: bool) -> DataFrame:
    """(host, payload, shape, nodes, hashes, chars): a page's nodes that hold
    text; payload is a hash of the whole, equal for copies."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads, shapes, nodes, hashes, chars = [], [], [], [], []
            for page in batch.column(1).to_pylist():
                shape, blocks = shaped(tree(page or "", lists))
                found = text_hashes(blocks)
                shapes.append(to_text(shape))
                nodes.append(list(found))
                hashes.append(list(found.values()))
                chars.append(list(free_text(blocks).values()))
                payloads.append(xxhash.xxh64_intdigest(f"{shapes[-1]}{nodes[-1]}{hashes[-1]}") - (1 << 63))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(payloads, pa.int64()), pa.array(shapes, pa.string()), pa.array(nodes, pa.list_(pa.int32())),
                 pa.array(hashes, pa.list_(pa.int64())), pa.array(chars, pa.list_(pa.int64()))],
                ["host", "payload", "shape", "nodes", "hashes", "chars"],
            )

    return pages.select(host(F.col("url")).alias("host"), "html").mapInArrow(
        work, "host string, payload long, shape string, nodes array<int>, hashes array<long>, chars array<long>"
    )


def _aligned(parsed: DataFrame) -> DataFrame:
    """(host, node, hash, chars) for each text node that matches one of the wrapper."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, at, found, weights = [], [], [], []
            for name, shape, nodes, hashes, chars, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                places = matched_texts(shape, wrapper)
                for node, value, n in zip(nodes, hashes, chars, strict=True):
                    if node in places:
                        hosts.append(name)
                        at.append(places[node])
                        found.append(value)
                        weights.append(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(at, pa.int32()), pa.array(found, pa.int64()), pa.array(weights, pa.int64())],
                ["host", "node", "hash", "chars"],
            )

    rows = parsed.select("host", "shape", "nodes", "hashes", "chars", "wrapper")
    return rows.mapInArrow(work, "host string, node int, hash long, chars long")


def content_nodes(wrapper: Shape, weight: dict[int, int]) -> list[int]:
    """The wrapper's nodes that are content, from the weights of its slots: the
    element of the content first, then headings above it."""
    labels: list[str] = []
    parents: list[int] = []

    def number(node: Shape, parent: int) -> None:
        at = len(labels)
        labels.append(node[0].split(".")[0])
        parents.append(parent)
        for child in node[1]:
            number(child, at)

    number(wrapper, -1)
    whole = [weight.get(i, 0) for i in range(len(labels))]
    for i in range(len(labels) - 1, 0, -1):
        whole[parents[i]] += whole[i]
    slot = max(weight, key=lambda i: (weight[i], -i))
    if not weight[slot]:
        return []
    at = slot
    while labels[at] in ("#", "flow", *HEADINGS) and parents[at] >= 0:
        at = parents[at]
    here = at
    while parents[here] >= 0:
        here = parents[here]
        if whole[here] - whole[at] >= GAIN * whole[at]:
            at = here
    here = at
    while here >= 0:
        at = here if labels[here] in ("article", "main") else at
        here = parents[here]
    above, here = [], at
    while parents[here] >= 0:
        here = parents[here]
        above.append(here)
    return [at, *(i for i in range(len(labels)) if labels[i] == "h1" and parents[i] in above)]


def _with_content(found: DataFrame) -> DataFrame:
    """(host, wrapper, template, content) from the wrappers and their slots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for wrapper, slots in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True):
                weight = {s["node"]: s["chars"] for s in slots or []}
                held.append(content_nodes(from_text(wrapper), weight) if weight else [])
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(held, pa.list_(pa.int32()))], ["host", "wrapper", "template", "content"])

    schema = "host string, wrapper string, template array<struct<node:int,hash:bigint>>, content array<int>"
    return found.select("host", "wrapper", "template", "slots").mapInArrow(work, schema)


def wrappers(pages: DataFrame, label: str = "wrappers", lists: bool = True) -> DataFrame:
    """(host, wrapper, template, content): the wrapper's shape, node and hash of
    each template text, and the nodes of the content, none where no slot has
    text on ``LEAST_PAGES`` pages. Copies of a page count as one page."""
    ship_code(pages.sparkSession)
    parsed = stage(_parsed(pages, lists).dropDuplicates(["host", "payload"]), f"{label}-parsed")
    common = parsed.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"))
    seeds = stage(common.groupBy("host").agg(F.max_by("shape", F.struct("n", "shape")).alias("wrapper")), f"{label}-seeds")
    texts = _aligned(parsed.join(seeds, "host")).groupBy("host", "node", "hash").agg(F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"))
    nodes = texts.groupBy("host", "node").agg(
        F.sum("n").alias("pages"), F.max("n").alias("same"), F.max_by("hash", F.struct("n", "hash")).alias("hash"), F.sum("chars").alias("chars")
    )
    known = nodes.where(F.col("pages") >= LEAST_PAGES)  # at most as many rows as one shape has nodes
    constant = F.col("same") >= CONSTANT * F.col("pages")
    of_host = known.groupBy("host").agg(
        F.sort_array(F.collect_list(F.when(constant, F.struct("node", "hash")))).alias("template"),
        F.sort_array(F.collect_list(F.when(~constant, F.struct("node", "chars")))).alias("slots"),
    )
    return stage(_with_content(seeds.join(of_host, "host", "left")), label)


def extract(pages: DataFrame, wrapped: DataFrame | None = None, lists: bool = True) -> DataFrame:
    """(page_id, url, text) of every page."""
    wrapped = wrappers(pages, lists=lists) if wrapped is None else wrapped
    ship_code(pages.sparkSession)

    def spans(shape: Shape, wanted: list[int], places: dict[int, int]) -> list[range]:
        """Numbers of the nodes in and below those that match the wanted ones."""
        roots, found = {i for i, j in places.items() if j in set(wanted)}, []
        at = 0

        def walk(node: Shape) -> None:
            nonlocal at
            if at in roots:
                found.append(range(at, at + size(node)))
                at += size(node)
                return
            at += 1
            for child in node[1]:
                walk(child)

        walk(shape)
        return found

    def content(page: str, wrapper: str | None, template: list[dict], wanted: list[int]) -> str:
        shape, blocks = shaped(tree(page, lists))
        places: dict[int, int] = {}
        same: set[int] = set()
        if wrapper:
            places, constant = matched_texts(to_text(shape), wrapper), {(t["node"], t["hash"]) for t in template}
            same = {node for node, value in text_hashes(blocks).items() if (places.get(node), value) in constant}
        if wanted:
            held = spans(shape, wanted[:1], places)
            if any(b[0] in span for span in held for b in blocks):
                held += spans(shape, wanted[1:], places)
                inside = [b for b in blocks if any(b[0] in span for span in held)]
                main = [b for b in inside if b[2]]
                if main or not any(b[2] for b in blocks):  # else the article is elsewhere: another template
                    return "\n".join(b[1] for b in main or [b for b in inside if b[0] not in same] or inside)
        if any(main for _, _, main, _ in blocks):
            return "\n".join(b[1] for b in blocks if b[2])
        free, full = free_text(blocks), dict[int, int]()
        for node, text, _, _ in blocks:
            full[node] = full.get(node, 0) + len(text)
        blocks = [b for b in blocks if free[b[0]] > (1 - LINKED) * full[b[0]]] or blocks
        return "\n".join(b[1] for b in [b for b in blocks if b[0] not in same] or blocks)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4, 5)), strict=True)
            found = [content(p or "", w, t or [], c or []) for p, w, t, c in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["page_id", "url", "text"])

    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"))
    return rows.join(wrapped, "host", "left").select("page_id", "url", "html", "wrapper", "template", "content").mapInArrow(
        work, "page_id long, url string, text string"
    )


def op4_wrapper_extraction(spark, folder: str) -> DataFrame:
    """Per page: its main text and that text's code points."""
    found = extract(table(spark, folder, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
