"""Markdown chunks within a budget of tokens, with title and section path, idempotent by chunker version."""

from __future__ import annotations

import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "v2"
#: Characters of chunks that a task holds before it gives them on.
PIECE = 1 << 20
_HEADING = re.compile(r"^(#{1,6}) +(.*)$")
#: Where a block that is over the limit may be cut, best places first: between lines, sentences, words.
_CUTS = [re.compile(r"\n"), re.compile(r"[.!?]\s+"), re.compile(r"\s+")]


def words(text: str) -> int:
    """The stand-in token counter."""
    return len(text.split())


def blocks_of(md: str) -> list[tuple[int, int]]:
    """Starts and ends of paragraphs, headings, tables and $$ blocks; the lines of a table, and all between two $$, are one block."""
    out, at, inside = [], 0, False
    for piece in re.split(r"(\n{2,})", md):
        if piece.strip():
            if inside:
                out[-1] = (out[-1][0], at + len(piece))
            else:
                out.append((at, at + len(piece)))
            inside ^= piece.count("$$") % 2 == 1
        at += len(piece)
    return out


def fitting(md: str, start: int, end: int, fits: Callable[[int, int], bool], level: int = 0) -> list[tuple[int, int]]:
    """A block in parts that fit, cut at the best places that do; a word too long for any is cut in halves."""
    if fits(start, end) or end - start <= 1:
        return [(start, end)]
    if level == len(_CUTS):
        middle = (start + end) // 2
        return fitting(md, start, middle, fits, level) + fitting(md, middle, end, fits, level)
    edges = [start, *(m.end() for m in _CUTS[level].finditer(md, start, end) if m.end() < end), end]
    out: list[tuple[int, int]] = []
    for a, z in zip(edges, edges[1:], strict=False):
        if out and out[-1][1] == a and fits(out[-1][0], z):
            out[-1] = (out[-1][0], z)
        else:
            out += fitting(md, a, z, fits, level + 1)
    return out


def split_markdown(md: str, least: int = 512, most: int = 1024, count: Callable[[str], int] = words, title: str = "") -> list[dict]:
    """Chunks of at most ``most`` tokens: char_start, char_end, n_tokens, section, text, and content, which has title and section path before the text.

    Blocks are put together while the content stays within the limit; a heading
    begins anew once a chunk has ``least`` tokens or belongs to a section above.  A
    table or $$ block stays whole unless it is over the limit by itself; then it is cut
    between lines, as other blocks are.  n_tokens are those of the content.
    """
    md = md or ""
    out: list[dict] = []
    path: list[tuple[int, str]] = []
    open_at: list = []  # start, end, path of the chunk being made

    def head(section: str) -> str:
        both = " > ".join(x for x in (title, section) if x)
        # a path that would fill the chunk gives way to the text
        return f"{both}\n\n" if both and count(both) <= most // 2 else ""

    def content(start: int, end: int, section: str) -> str:
        return head(section) + md[start:end]

    def flush() -> None:
        if open_at:
            start, end, section = open_at
            whole = content(start, end, section)
            out.append({"char_start": start, "char_end": end, "n_tokens": count(whole), "section": section, "text": md[start:end], "content": whole})
            open_at.clear()

    for a, z in blocks_of(md):
        found = _HEADING.match(md[a:z].split("\n", 1)[0])
        if found:
            level = len(found[1])
            if open_at and (count(content(*open_at)) >= least or (path and level < path[-1][0])):
                flush()
            path = [p for p in path if p[0] < level] + [(level, found[2].strip())]
        section = " > ".join(p[1] for p in path)
        if open_at and count(content(open_at[0], z, open_at[2])) <= most:
            open_at[1] = z
            continue
        flush()
        for x, y in fitting(md, a, z, lambda i, j, section=section: count(content(i, j, section)) <= most):
            flush()
            open_at[:] = [x, y, section]
    flush()
    return out


def chunk_documents(docs: DataFrame, key: str, md: str, least: int = 512, most: int = 1024, load: Callable[[], Callable[[str], int]] = lambda: words, title: str | None = None) -> DataFrame:
    """key, chunk_index, char_start, char_end, n_tokens, section, text and content of each chunk.

    load: called once a task, gives count(text) -> tokens; title: a column of titles.
    """
    kind = dict(docs.dtypes)[key]
    names = ["chunk_index", "char_start", "char_end", "n_tokens", "section", "text", "content"]

    def run(frames):
        count = load()
        for f in frames:
            titles = f["_title"].fillna("") if title else [""] * len(f)
            rows, size = [], 0
            for k, m, head in zip(f[key], f[md], titles, strict=True):
                for i, c in enumerate(split_markdown(m, least, most, count, head)):
                    rows.append({key: k, "chunk_index": i, **c})
                    size += len(c["text"]) + len(c["content"])
                    if size > PIECE:
                        yield pd.DataFrame(rows, columns=[key, *names])
                        rows, size = [], 0
            yield pd.DataFrame(rows, columns=[key, *names])

    rows = docs.select(key, md, *([F.col(title).cast("string").alias("_title")] if title else []))
    return rows.mapInPandas(run, f"{key} {kind}, chunk_index int, char_start int, char_end int, n_tokens int, section string, text string, content string")


def pending_documents(docs: DataFrame, chunks: DataFrame, key: str, version: str = VERSION) -> DataFrame:
    """Documents that this chunker version has not cut."""
    return docs.join(chunks.where(F.col("chunker_version") == version).select(key).distinct(), key, "left_anti")
