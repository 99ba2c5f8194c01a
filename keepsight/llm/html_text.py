"""Main text of web pages by deducing each host's template from equivalence classes.

The tokens of a page are the roles of its elements (numbers of their paths) and its blocks of
text. Tokens with the same occurrence vector over the pages of a host (how often in which page)
are one class; vectors are compared by a sum of hashes that folds on the map side, so a host of
any size is a few sums. Of the classes that most pages hold, once each, the one on most pages is
the root; its tokens cut each page into gaps. A class is valid in so far as its tokens come in one
order and lie in one gap of the root on all pages: such tokens are the template, nested by their
parents. Any other role lies in the slot of the deepest template role around it. Text in a valid
class of all pages is the template's, in articles too; outside articles so is text of most pages.
Slots are chosen on every page alike, as a whole and from all pages of the host: by their own text,
which is neither the template's nor links. Names of elements only hint: a slot named as beside the
text goes unless it holds most of the host's own text, and slots named as the main part are taken
alone if no other slot holds more.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keepsight.llm.page_blocks import parse
from keepsight.llm.store import python_path, stored
from keepsight.llm.url_rules import url_host

#: Pages of a host from which on repeated text is taken for its template.
TEMPLATE_PAGES = 4
#: Different pages of a host from which on text of all its articles is taken for its template.
ARTICLE_PAGES = 8

_BLOCK = pa.struct(
    [
        ("role", pa.int64()),
        ("text", pa.string()),
        ("digest", pa.int64()),
        ("link_chars", pa.int64()),
        ("beside", pa.bool_()),
        ("main", pa.bool_()),
    ]
)
_TOKEN = pa.struct([("token", pa.int64()), ("parent", pa.int64()), ("n", pa.int64()), ("at", pa.int64())])
_PARSED = (
    "blocks array<struct<role: bigint, text: string, digest: bigint, link_chars: bigint, beside: boolean, "
    "main: boolean>>, tokens array<struct<token: bigint, parent: bigint, n: bigint, at: bigint>>, content bigint"
)
#: Pages that one record batch holds.
_ROWS = 200


def _parse_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    page = TaskContext.get().partitionId() << 33
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            some = batch.slice(start, _ROWS)
            found = [parse(x.as_py() or "") for x in some.column(some.num_columns - 1)]
            blocks = [
                [
                    {
                        "role": b.role,
                        "text": b.text,
                        "digest": b.digest(),
                        "link_chars": b.link_chars,
                        "beside": b.beside,
                        "main": b.main,
                    }
                    for b in own
                ]
                for own, _ in found
            ]
            tokens = [
                [{"token": k, "parent": t.parent, "n": t.times, "at": t.at} for k, t in own.items()]
                for _, own in found
            ]
            contents = [hash(tuple(b["digest"] for b in own)) for own in blocks]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(range(page, page + len(found)), pa.int64()),
                    *some.columns[:-1],
                    pa.array(blocks, pa.list_(_BLOCK)),
                    pa.array(tokens, pa.list_(_TOKEN)),
                    pa.array(contents, pa.int64()),
                ],
                names=["page", *some.schema.names[:-1], "blocks", "tokens", "content"],
            )
            page += len(found)


def _ends(column: pa.ListArray) -> np.ndarray:
    """Where each row's values start in `column.flatten()`, and the end."""
    return np.concatenate([[0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])


def _values(column: pa.ListArray, name: str) -> list:
    return column.flatten().field(name).to_pylist()


def _places_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each token of the classes on a page its place in its class, and its gap of the root."""
    for batch in batches:
        tokens, classes = batch.column("tokens"), batch.column("classes")
        token, at = _values(tokens, "token"), _values(tokens, "at")
        member, vector = _values(classes, "token"), _values(classes, "vector")
        ends, edges = _ends(tokens), _ends(classes)
        roots = batch.column("root").to_pylist()
        rows: list[int] = []
        out: list[tuple[int, int, int]] = []
        for i in range(batch.num_rows):
            of = dict(zip(member[edges[i] : edges[i + 1]], vector[edges[i] : edges[i + 1]], strict=True))
            own = sorted((at[j], token[j]) for j in range(ends[i], ends[i + 1]) if token[j] in of)
            met: dict[str, int] = {}
            for _, one in own:
                kind = of[one]
                out.append((one, met.get(kind, 0), met.get(roots[i], 0)))
                met[kind] = met.get(kind, 0) + 1
                rows.append(i)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("host").take(pa.array(rows, pa.int64())),
                *(pa.array([x[k] for x in out], pa.int64()) for k in range(3)),
            ],
            names=["host", "token", "place", "gap"],
        )


def _slots_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pages with the blocks' slots in place of their roles, and without the template's text."""
    for batch in batches:
        tokens, blocks, frames = (batch.column(c) for c in ("tokens", "blocks", "frame"))
        token, parent = _values(tokens, "token"), _values(tokens, "parent")
        role, digest, main = (_values(blocks, c) for c in ("role", "digest", "main"))
        ends, edges = _ends(tokens), _ends(blocks)
        slots: list[int] = []
        known: list[bool] = []
        host = frame = fixed = repeated = None
        for i, name in enumerate(batch.column("host").to_pylist()):
            if frame is None or name != host:
                host = name
                frame, fixed, repeated = (
                    frozenset(batch.column(c)[i].as_py() or ()) for c in ("frame", "fixed", "repeated")
                )
            # an element's role comes before those of the elements in it
            slot = {0: 0}
            for j in range(ends[i], ends[i + 1]):
                if parent[j] is not None:
                    slot[token[j]] = token[j] if token[j] in frame else slot[parent[j]]
            for j in range(edges[i], edges[i + 1]):
                slots.append(slot[role[j]])
                known.append(digest[j] in fixed or (not main[j] and digest[j] in repeated))
        own = pa.array(np.flatnonzero(~np.array(known, bool)), pa.int64())
        flat = blocks.flatten()
        names = [field.name for field in flat.type if field.name not in ("role", "digest")]
        made = pa.StructArray.from_arrays(
            [pa.array(slots, pa.int64()).take(own), *(flat.field(n).take(own) for n in names)],
            names=["slot", *names],
        )
        left = np.concatenate([[0], np.cumsum(~np.array(known, bool))])[edges]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(c) for c in ("page_id", "url", "host")),
                pa.ListArray.from_arrays(pa.array(left, pa.int32()), made),
            ],
            names=["page_id", "url", "host", "blocks"],
        )


def _templates(parsed: DataFrame, sizes: DataFrame) -> DataFrame:
    """For each host the roles of its template (`frame`) and the texts of it in articles (`fixed`)."""
    tokens = parsed.select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
    vector = F.sum(F.xxhash64("page", "n").cast("decimal(20,0)")).cast("string")
    found = tokens.groupBy("host", "token").agg(
        vector.alias("vector"),
        F.count(F.lit(1)).alias("support"),
        F.sum("n").alias("times"),
        F.max(F.col("parent").isNull()).alias("is_text"),
    )
    once = found.join(sizes, "host").where("2 * support > pages and times = support")
    once = stored(once, "classes")
    root = (
        once.groupBy("host", "vector", "support")
        .agg(F.count(F.lit(1)).alias("tokens"))
        .groupBy("host")
        .agg(F.max(F.struct("support", "tokens", "vector"))["vector"].alias("root"))
    )
    classes = once.groupBy("host").agg(F.collect_list(F.struct("token", "vector")).alias("classes"))
    places = (
        parsed.select("host", "tokens")
        .join(stored(classes.join(root, "host"), "roots"), "host")
        .mapInArrow(_places_task, "host string, token bigint, place bigint, gap bigint")
        .groupBy("host", "token")
        .agg(
            F.min("place").alias("place"),
            F.max("place").alias("last_place"),
            F.min("gap").alias("gap"),
            F.max("gap").alias("last_gap"),
        )
        .where("place = last_place and gap = last_gap")
    )
    valid = once.join(places.select("host", "token"), ["host", "token"])
    everywhere = F.col("is_text") & (F.col("support") == F.col("pages"))
    varied = (F.col("contents") >= ARTICLE_PAGES) & (2 * F.col("contents") > F.col("pages"))
    return valid.groupBy("host").agg(
        F.collect_list(F.when(~F.col("is_text"), F.col("token"))).alias("frame"),
        F.collect_list(F.when(everywhere & varied, F.col("token"))).alias("fixed"),
    )


def _key(slot, beside, main):
    return F.concat_ws("|", beside.cast("string"), main.cast("string"), slot.cast("string"))


def _choices(each: DataFrame) -> DataFrame:
    """For each host the slots that are taken, and whether its main ones are taken alone.

    `each` has the characters of text that isn't the template's, and those of links, by slot.
    """
    own = F.col("chars") - F.col("links")
    total = each.groupBy("host").agg(F.sum(own).alias("total"))
    taken = each.join(total, "host").where(
        (F.col("main") | (2 * F.col("links") <= F.col("chars")))
        & (~F.col("beside") | (2 * own > F.col("total")))
    )
    main = F.sum(F.when(F.col("main"), own))
    other = F.max(F.when(~F.col("main"), own))
    return taken.groupBy("host").agg(
        F.collect_set(_key(F.col("slot"), F.col("beside"), F.col("main"))).alias("taken"),
        F.coalesce(main >= other, F.lit(True)).alias("main_first"),
    )


def extract_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Main text of every page: `page_id`, `url`, `text` and `n_chars` (its code points).

    Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles, markup and
    reader comments are left out, by the host's template (text that all of `ARTICLE_PAGES` or more
    different pages hold once, in one order; outside an article all repeated text) and by slots
    that are mostly links or are named so and don't hold most of the host's own text. If
    no other slot of the host holds more than its articles, a page with an article gives the
    article alone, in full. Character references are decoded, white space in
    a block becomes one space, blocks are joined by one space.

    Html that is NULL, empty or without text gives an empty text. A url NULL or without `://`
    belongs to the host of empty name. Hosts with few pages have no repeated text to leave out.
    Repeated rows and ids NULL are pages one by one; an empty table gives no rows; other columns
    are not read.
    """
    python_path(pages.sparkSession)
    kinds = {c: pages.schema[c].dataType.simpleString() for c in (id_column, url_column)}
    parsed = stored(
        pages.select(
            F.col(id_column).alias("page_id"),
            F.col(url_column).alias("url"),
            url_host(F.col(url_column)).alias("host"),
            F.col(html_column).alias("html"),
        ).mapInArrow(
            _parse_task,
            f"page bigint, page_id {kinds[id_column]}, url {kinds[url_column]}, host string, {_PARSED}",
        ),
        "parsed",
    )
    content = F.approx_count_distinct("content").alias("contents")
    sizes = stored(parsed.groupBy("host").agg(F.count(F.lit(1)).alias("pages"), content), "hosts")
    frames = stored(_templates(parsed, sizes), "frames")

    blocks = parsed.select("host", "page", F.explode("blocks").alias("b"))
    repeated = (
        blocks.where("not b.main")
        .select("host", "page", F.col("b.digest").alias("digest"))
        .distinct()
        .groupBy("host", "digest")
        .agg(F.count(F.lit(1)).alias("support"))
        .join(sizes, "host")
        .where(2 * F.col("support") > F.col("pages"))
        .where(F.col("pages") >= TEMPLATE_PAGES)
        .groupBy("host")
        .agg(F.collect_list("digest").alias("repeated"))
    )
    hosts = sizes.select("host").join(frames, "host", "left").join(stored(repeated, "repeated"), "host", "left")
    hosts = stored(hosts, "templates")
    def slotted(**columns: str) -> DataFrame:
        """The pages with the slots of their blocks that aren't the template's, and such columns."""
        values = ", ".join(f"{value} as {name}" for name, value in columns.items())
        light = f"transform(blocks, b -> struct(b.role, b.digest, b.beside, b.main, {values}))"
        own = ", ".join(f"{name}: {'string' if name == 'text' else 'bigint'}" for name in columns)
        return (
            parsed.select("page_id", "url", "host", F.expr(light).alias("blocks"), "tokens")
            .join(hosts, "host")
            .mapInArrow(
                _slots_task,
                f"page_id {kinds[id_column]}, url {kinds[url_column]}, host string, "
                f"blocks array<struct<slot: bigint, beside: boolean, main: boolean, {own}>>",
            )
        )

    # texts are not stored a second time: sizes come first, the texts with the chosen slots
    by_slot = (
        slotted(chars="bigint(length(b.text))", links="b.link_chars")
        .select("host", F.explode("blocks").alias("b"))
        .groupBy("host", "b.slot", "b.beside", "b.main")
        .agg(F.sum("b.chars").alias("chars"), F.sum("b.links").alias("links"))
    )
    choices = stored(sizes.select("host").join(_choices(by_slot), "host", "left"), "choices")
    taken = F.coalesce("taken", F.array().cast("array<string>"))
    kept = F.filter("blocks", lambda b: F.array_contains(taken, _key(b["slot"], b["beside"], b["main"])))
    first = F.exists("kept", lambda b: b["main"]) & F.col("main_first")
    chosen = F.filter("kept", lambda b: ~first | b["main"])
    text = F.array_join(F.transform(chosen, lambda b: b["text"]), " ")
    return (
        slotted(text="b.text")
        .join(choices, "host")
        .select("page_id", "url", "main_first", kept.alias("kept"))
        .select("page_id", "url", text.alias("text"))
        .withColumn("n_chars", F.length("text").cast("bigint"))
    )
