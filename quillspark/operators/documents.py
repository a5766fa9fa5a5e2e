"""Layout blocks to html and markdown, page statistics, figures, and their files."""

from __future__ import annotations

import re
from collections.abc import Callable
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import storage
from ..functions import text
from ..sources import readers

IMAGE_LABELS = ("Image", "Figure")
EDGE_LABELS = ("Page-Header", "Page-Footer")


def blocks_html(blocks: Column, edges: bool = False, images: bool = True, prefix: Column | None = None) -> Column:
    """The html of an array of (label, content, bbox), by label; images are named by their place, from 1, after a prefix (of the page)."""
    skip = ["Blank-Page", *([] if edges else EDGE_LABELS), *([] if images else IMAGE_LABELS)]

    def one(b, i):
        name = F.concat(F.lit('src="'), *([] if prefix is None else [prefix]), F.lit("block_"), (i + 1).cast("string"), F.lit('.webp"'))
        has_src = b["content"].rlike(r"<img[^>]*\ssrc=")
        image = F.when(has_src, b["content"]).when(b["content"].rlike("<img"), F.regexp_replace(b["content"], "<img", F.concat(F.lit("<img "), name))).otherwise(F.concat(F.lit("<img "), name, F.lit(">"), b["content"]))
        plain = F.when(~text.has_tag(b["content"]) & (b["label"] == "Text"), F.concat(F.lit("<p>"), b["content"], F.lit("</p>"))).otherwise(b["content"])
        return F.when(b["label"].isin(skip), None).when(b["label"].isin(*IMAGE_LABELS), image).otherwise(plain)

    return F.array_join(F.filter(F.transform(blocks, one), lambda x: x.isNotNull()), "")


def figures(blocks: Column, prefix: Column | None = None, tagged: bool = False) -> Column:
    """(name, bbox) of each image block whose box is not empty; tagged: only of those whose content has an image tag."""
    name = lambda i: F.concat(*([] if prefix is None else [prefix]), F.lit("block_"), (i + 1).cast("string"), F.lit(".webp"))
    named = F.transform(blocks, lambda b, i: F.struct(name(i).alias("name"), b["bbox"].alias("bbox"), b["label"].alias("label"), b["content"].alias("content")))
    valid = lambda f: f["label"].isin(*IMAGE_LABELS) & (F.size(f["bbox"]) == 4) & (F.get(f["bbox"], F.lit(2)) > F.get(f["bbox"], F.lit(0))) & (F.get(f["bbox"], F.lit(3)) > F.get(f["bbox"], F.lit(1)))
    return F.filter(named, lambda f: valid(f) & F.lower(f["content"]).contains("<img") if tagged else valid(f))


def netpbm():
    """A codec of binary PGM and PPM images of one byte a sample; other formats are injected alike."""

    def decode(raw: bytes) -> np.ndarray:
        head = re.match(rb"P([56])((?:\s+(?:#[^\n]*\n\s*)*\d+){3})\s", raw)
        if head is None:
            raise ValueError("not a binary PGM or PPM image")
        width, height, most = (int(x) for x in re.sub(rb"#[^\n]*\n", b" ", head[2]).split())
        depth = 3 if head[1] == b"6" else 1
        if most > 255 or len(raw) - head.end() < width * height * depth:
            raise ValueError("an image of wide samples or cut short")
        return np.frombuffer(raw, np.uint8, width * height * depth, head.end()).reshape(height, width, depth)

    def encode(pixels: np.ndarray) -> bytes:
        height, width, depth = pixels.shape
        return f"P{6 if depth == 3 else 5}\n{width} {height}\n255\n".encode() + pixels.tobytes()

    return decode, encode


def crop(pixels: np.ndarray, box: list[int]) -> np.ndarray:
    """The pixels of (left, upper, right, lower); black where the box reaches beyond the image."""
    left, upper, right, lower = (int(x) for x in box)
    height, width = pixels.shape[:2]
    out = np.zeros((lower - upper, right - left, pixels.shape[2]), pixels.dtype)
    x0, y0, x1, y1 = max(left, 0), max(upper, 0), min(right, width), min(lower, height)
    if x0 < x1 and y0 < y1:
        out[y0 - upper : y1 - upper, x0 - left : x1 - left] = pixels[y0:y1, x0:x1]
    return out


def crop_figures(pages: DataFrame, load: Callable[[], tuple[Callable, Callable]] = netpbm, key: str = "arxiv_id", prefix: Column | None = None) -> DataFrame:
    """key, page, name and image of the figures of pages (key, page, image, blocks); an unreadable page has one row with an error.

    load: called once a task; gives decode(bytes) -> pixels (height, width, samples) and encode(pixels) -> bytes.
    Blocks without an image tag or with an empty box give no figure.
    """
    kind = dict(pages.dtypes)[key]
    rows = pages.select(key, F.col("page").cast("int").alias("page"), "image", F.transform(figures(F.col("blocks"), prefix, tagged=True), lambda f: F.struct(f["name"].alias("name"), f["bbox"].cast("array<int>").alias("bbox"))).alias("figures"))

    def run(frames):
        decode, encode = load()
        for f in frames:
            out = []
            for k, page, image, boxes in zip(f[key], f["page"], f["image"], f["figures"], strict=True):
                try:
                    pixels = decode(bytes(image))
                    out += [(k, page, b["name"], encode(crop(pixels, b["bbox"])), None) for b in boxes]
                except Exception as e:
                    out.append((k, page, None, None, f"error: {e}"))
            yield pd.DataFrame(out, columns=[key, "page", "name", "image", "error"])

    return rows.where(F.size("figures") > 0).mapInPandas(run, f"{key} {kind}, page int, name string, image binary, error string")


def save_figures(crops: DataFrame, folder: str, key: str = "arxiv_id") -> DataFrame:
    """key, page, name and path of figures, whose files the tasks write beside the document's others."""

    def run(frames):
        for f in frames:
            paths = [f"{folder.rstrip('/')}/{k}/{name}" for k, name in zip(f[key], f["name"], strict=True)]
            for path, image in zip(paths, f["image"], strict=True):
                atomic_write(path, bytes(image))
            yield pd.DataFrame({key: f[key].astype(str), "page": f["page"], "name": f["name"], "path": paths})

    return crops.where("name is not null").select(key, "page", "name", "image").mapInPandas(run, f"{key} string, page int, name string, path string")


class _Markdown(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.hide, self.lists, self.links = [], 0, [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hide += 1
        elif re.fullmatch("h[1-6]", tag):
            self.out.append("\n\n" + "#" * int(tag[1]) + " ")
        elif tag in ("p", "div", "table", "article", "section"):
            self.out.append("\n\n")
        elif tag in ("br", "tr"):
            self.out.append("\n")
        elif tag in ("td", "th"):
            self.out.append(" | ")
        elif tag in ("ul", "ol"):
            self.lists.append([tag, 0])
            self.out.append("\n")
        elif tag == "li":
            kind = self.lists[-1] if self.lists else ["ul", 0]
            kind[1] += 1
            self.out.append("\n" + "  " * max(0, len(self.lists) - 1) + ("- " if kind[0] == "ul" else f"{kind[1]}. "))
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag == "math":
            self.out.append("$$" if dict(attrs).get("display") == "block" else "$")
            self.links.append("$$" if dict(attrs).get("display") == "block" else "$")
        elif tag == "img":
            a = dict(attrs)
            self.out.append(f"![{a.get('alt') or ''}]({a.get('src') or ''})")
        elif tag == "a":
            self.out.append("[")
            self.links.append(f"]({dict(attrs).get('href') or ''})")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hide = max(0, self.hide - 1)
        elif tag in ("b", "strong"):
            self.out.append("**")
        elif tag in ("i", "em"):
            self.out.append("*")
        elif tag in ("a", "math") and self.links:
            self.out.append(self.links.pop())
        elif tag in ("ul", "ol") and self.lists:
            self.lists.pop()
        elif re.fullmatch("h[1-6]|p|div|table|article|section", tag):
            self.out.append("\n\n")

    def handle_data(self, data):
        if not self.hide:
            inside = self.links and self.links[-1].startswith("$")
            data = data if inside else re.sub(r"([_*$])", r"\\\1", re.sub(r"\s+", " ", data))
            self.out.append(data)


def to_markdown(html: str | None) -> str:
    """Markdown of html; empty where it cannot be read."""
    try:
        p = _Markdown()
        p.feed(html or "")
        p.close()
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+\n", "\n", "".join(p.out))).strip()
    except Exception:
        return ""


def markdown(df: DataFrame, html: str, out: str = "markdown", convert: Callable[[str], str] = to_markdown) -> DataFrame:
    """The column of markdown; the converter can be replaced."""
    f = F.pandas_udf(lambda s: s.map(convert), "string")
    return df.withColumn(out, f(F.col(html)))


def ocr_pages(images: DataFrame, load: Callable[[], Callable[[list], list[dict]]], max_output_tokens: int = 8192, convert: Callable[[str], str] = to_markdown) -> DataFrame:
    """arxiv_id, page, image rows to raw text, markdown and statistics a page.

    load: called once a task; gives ocr(images) -> [{raw, token_count, error}].
    """

    def run(frames):
        ocr = load()
        for f in frames:
            got = ocr(f["image"].tolist())
            if len(got) != len(f):
                raise ValueError("the OCR gave another number of pages than it got")
            md = [convert(g.get("raw") or "") for g in got]
            yield pd.DataFrame({
                "arxiv_id": f["arxiv_id"].tolist(), "page": f["page"].tolist(), "raw": [g.get("raw") for g in got], "markdown": md,
                "n_tokens": [g.get("token_count") for g in got], "n_chars": [len(m) for m in md], "n_images": [m.count("![") for m in md],
                "error": [g.get("error") for g in got], "truncated": [(g.get("token_count") or 0) >= max_output_tokens for g in got],
            })

    return images.select(F.col("arxiv_id").cast("string"), F.col("page").cast("int"), "image").mapInPandas(run, "arxiv_id string, page int, raw string, markdown string, n_tokens int, n_chars int, n_images int, error string, truncated boolean")


def join_document(pages: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """One row a document: html (raw) and markdown, pages in order after their markers."""
    return pages.groupBy(key).agg(text.join_pages(F.col("page"), F.col("raw")).alias("html"), text.join_pages(F.col("page"), F.col("markdown")).alias("md"), F.count(F.lit(1)).cast("int").alias("nb_pages_ocr"), F.max(F.col("error").isNotNull()).alias("has_error"))


def run_ocr(images: DataFrame, load: Callable[[], Callable[[list], list[dict]]], run: str, target: str, max_output_tokens: int = 8192, convert: Callable[[str], str] = to_markdown, crops: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The page rows, and the documents whose files are written to target; the OCR sees each page once.

    Pages go to <run>/pages, documents to <run>/documents, and both are read from
    there, however often.  A run that broke off goes on: what was written whole is
    taken as it is, so a new run needs a new folder.  crops (of crop_figures) are
    written first, so a document's markdown still marks it as complete.
    """
    spark = images.sparkSession
    pages = storage.once(spark, f"{run}/pages", lambda: ocr_pages(images, load, max_output_tokens, convert))
    if crops is not None:
        storage.once(spark, f"{run}/figures", lambda: save_figures(crops, target))
    return pages, storage.once(spark, f"{run}/documents", lambda: save_documents(join_document(pages), target))


def atomic_write(path: str, body: bytes | str) -> None:
    """Write beside the file, then move; to any store that pyarrow reaches."""
    fs, at = readers.store(path)
    readers.put(fs, at, body.encode() if isinstance(body, str) else body)


def save_documents(docs: DataFrame, folder: str, key: str = "arxiv_id") -> DataFrame:
    """key and ocr_path of documents (html, md) whose files the tasks write; nb_pages_ocr and has_error go along."""

    def run(frames):
        for f in frames:
            paths = [save_document(folder, str(k), html or "", md or "", {}) for k, html, md in zip(f[key], f["html"], f["md"], strict=True)]
            yield pd.DataFrame({key: f[key], "ocr_path": paths, "nb_pages_ocr": f["nb_pages_ocr"], "has_error": f["has_error"]})

    return docs.select(key, "html", "md", "nb_pages_ocr", "has_error").mapInPandas(run, f"{key} string, ocr_path string, nb_pages_ocr int, has_error boolean")


def ocr_queue(subset: DataFrame, done: DataFrame, key: str = "arxiv_id") -> DataFrame:
    """Documents of a subset without a finished file."""
    return subset.join(done.select(key), key, "left_anti")


def save_document(folder: str, arxiv_id: str, html: str, md: str, images: dict[str, bytes]) -> str:
    """html, figures, then markdown, whose presence marks the document as complete."""
    at = f"{folder.rstrip('/')}/{arxiv_id}"
    atomic_write(f"{at}/{arxiv_id}.html", html)
    for name, body in images.items():
        atomic_write(f"{at}/{name}", body)
    atomic_write(f"{at}/{arxiv_id}.md", md)
    return at
