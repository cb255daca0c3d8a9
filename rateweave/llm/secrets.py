"""Secrets in texts, and credentials whose parts stand near each other.

Strong patterns are reported wherever they match. Weak candidates, such as a user
name, a long mixed string or an endpoint, mean little alone: they are reported
when a complementary part lies in the same scope, which an interval join over the
parts of a document finds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rateweave.llm.tables import id_text, join_id, keep, text_mark, whole_rows

# Fixed patterns and least lengths of the strong kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")

# Weak candidates: the span reported is the whole match.
WEAK_ID = re.compile(
    r"""\b(?:access_key_id|client_id|account_id|user_?name|login)["']?\x20*[:=]\x20*["']?"""
    r"""[A-Za-z0-9_.@-]{3,}+""",
    re.IGNORECASE | re.ASCII,
)
WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}+={0,2}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"\b(?:https?|ftp|jdbc:[a-z]+|postgres(?:ql)?|mysql|redis|amqp)://[^\s\"'<>]+")

# Parts that complete each other lie at most so many code points apart.
SCOPE = 200
# Which role each kind plays, and which roles complete it.
ROLE = {
    "assign": "secret", "hex": "secret", "weak_secret": "secret",
    "access": "id", "weak_id": "id", "endpoint": "endpoint",
}
NEEDS = {"weak_id": ("secret",), "weak_secret": ("id", "endpoint"), "endpoint": ("secret",)}

HIDDEN = "[secret]"
SPAN = "struct<kind:int,start:int,stop:int>"
FOUND = (
    "row long, doc_id string, text_mark long, n_assign long, n_access long, n_hex long, "
    f"base_sha256 string, base array<{SPAN}>, weak array<{SPAN}>"
)


def strong_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the strong kinds, in that order."""
    out = [(*m.span(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    out += [(*m.span(), 1) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(*m.span(), 2) for m in HEX.finditer(text)]
    return sorted((start, kind, stop) for start, stop, kind in out)


def _mixed(run: str) -> bool:
    return all(re.search(kind, run) for kind in ("[0-9]", "[A-Z]", "[a-z]"))


def weak_spans(text: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak candidates that do not overlap a strong span.

    Of an identifier or mixed string that runs into a strong span, the part before
    that span is the candidate, if it is one by itself.
    """
    out = [(*m.span(), 3) for m in WEAK_ID.finditer(text)]
    out += [(*m.span(), 4) for m in WEAK_SECRET.finditer(text) if _mixed(m[0])]
    out += [(*m.span(), 5) for m in ENDPOINT.finditer(text)]
    taken, at, kept = [(a, b) for a, _, b in strong], 0, []
    for start, stop, kind in sorted(out):
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at < len(taken) and start < taken[at][0] < stop and kind in (3, 4):
            part = (WEAK_ID, WEAK_SECRET)[kind - 3].match(text, start, taken[at][0])
            if part and (kind == 3 or _mixed(part[0])):
                stop = part.end()
        if at == len(taken) or taken[at][0] >= stop:
            kept.append((start, kind, stop))
    return kept


def digest(spans: list[tuple[int, int, int]]) -> str:
    joined = ",".join(f"{KINDS[kind]}:{start}:{stop}" for start, kind, stop in spans)
    return hashlib.sha256(joined.encode()).hexdigest()


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        out = []
        for doc_id, text, mark in zip(batch.doc_id, batch.text, batch.text_mark, strict=True):
            text = text or ""
            strong = strong_spans(text)
            weak = weak_spans(text, strong)
            count = [sum(k == kind for _, k, _ in strong) for kind in range(3)]
            out.append((
                row, doc_id, mark, *count, digest(strong),
                [{"kind": k, "start": a, "stop": b} for a, k, b in strong],
                [{"kind": k, "start": a, "stop": b} for a, k, b in weak],
            ))
            row += 1
        columns = ["row", "doc_id", "text_mark", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak"]
        yield pd.DataFrame(out, columns=columns)


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Weak parts (``row``, ``kind``, ``start``, ``stop``) with a complement in scope.

    A sort-merge interval join: along each document the nearest part of every role
    before and after is carried, so no pairs are made. A part is in scope if the
    gap between both is at most ``scope`` code points.
    """
    role = F.element_at(
        F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (i, ROLE[k])]), F.col("kind")
    )
    order = Window.partitionBy("row").orderBy("start", "kind", "stop")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(1, Window.unboundedFollowing)
    parts = parts.withColumn("role", role)
    near = {}
    for name in ("secret", "id", "endpoint"):
        own = F.col("role") == name
        last = F.max(F.when(own, F.col("stop"))).over(before)
        first = F.min(F.when(own, F.col("start"))).over(after)
        near[name] = F.coalesce(F.col("start") - last <= scope, F.lit(False)) | F.coalesce(
            first - F.col("stop") <= scope, F.lit(False)
        )
    parts = parts.select("row", "kind", "start", "stop", *[v.alias(f"near_{k}") for k, v in near.items()])
    hit: Column = F.lit(False)
    for kind, needs in NEEDS.items():
        some: Column = F.lit(False)
        for need in needs:
            some = some | F.col(f"near_{need}")
        hit = hit | ((F.col("kind") == KINDS.index(kind)) & some)
    return parts.where(hit).select("row", "kind", "start", "stop")


def find_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Secrets of each document.

    Takes ``doc_id`` and ``text``; other columns are ignored. Gives per input row:
    doc_id, text_mark, n_assign, n_access, n_hex, base_sha256 (of the strong spans) and
    ``found``, an array of (start, kind, stop) of strong spans and linked weak ones
    in code points, by start and kind. A null or empty text has none; repeated rows
    and null ids keep their rows; an empty table gives none.
    """
    found = docs.select(id_text("doc_id"), "text", text_mark().alias("text_mark"))
    found = found.mapInPandas(_find, FOUND)
    found = keep(found, "secret-parts")
    parts = (
        found.where(F.size("weak") > 0)
        .select("row", F.explode(F.concat("base", "weak")).alias("part"))
        .select("row", "part.kind", "part.start", "part.stop")
    )
    shape = F.struct("start", "kind", "stop")
    extra = linked(parts, scope).groupBy("row").agg(F.collect_list(shape).alias("extra"))
    base = F.transform("base", lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.stop.alias("stop")))
    every = F.when(F.col("extra").isNull(), base).otherwise(F.array_sort(F.concat(base, "extra")))
    return found.join(extra, "row", "left").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text_mark",
        "n_assign", "n_access", "n_hex", "base_sha256", every.alias("found"),
    )


def _hide(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
    out = []
    for text, first, last in zip(texts, starts, stops, strict=True):
        if first is not None:
            parts, at = [], 0
            for start, stop in zip(first, last, strict=True):
                if start >= at:
                    parts += [text[at:start], HIDDEN]
                at = max(at, stop)
            text = "".join([*parts, text[at:]])
        out.append(text)
    return pd.Series(out)


def hide_secrets(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs`` with every secret but endpoints replaced by :data:`HIDDEN`.

    All rows and columns stay; ``n_chars``, if there, follows the new text.
    """
    found = find_secrets(docs, scope)
    hidden = F.filter("found", lambda x: x.kind != KINDS.index("endpoint"))
    found = found.select(
        join_id().alias("id"), F.col("text_mark").alias("mark"), hidden.alias("spans")
    )
    # Copies have the same spans.
    found = found.where(F.size("spans") > 0).dropDuplicates(["id", "mark"])
    joined = whole_rows(docs).join(found, ["id", "mark"], "left")
    hide = F.pandas_udf(_hide, "string")
    text = hide(F.col("row.text"), F.col("spans.start"), F.col("spans.stop"))
    changed = joined.select("row", F.col("spans").isNotNull().alias("changed"), text.alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        size = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("changed"), size).otherwise(F.col("row.n_chars"))
    return changed.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def span_text(found: str = "found") -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            found,
            lambda x: F.concat_ws(":", names[x.kind], x.start.cast("string"), x.stop.cast("string")),
        ),
        ",",
    )
