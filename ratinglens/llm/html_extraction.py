"""Operator 13: the main text of web pages, from flat text blocks classified by a decision tree."""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import html_blocks as B
from .decision_tree import expression, fit_tree
from .labelled_pages import LAYOUTS, labelled_html

SLICE_CHARS = 4 << 20       # pages go to Spark's rows in slices of about so many characters, or one longer page
FLAGS = (B.HEADING, B.BOILER_TAG, B.BAD_NAME, B.IN_ARTICLE, B.GOOD_NAME, B.IN_HEADER, B.SENTENCE)
FEATURES = ("words", "link_density", "words_before", "link_density_before", "words_after", "link_density_after",
            "heading", "boiler_tag", "bad_name", "in_article", "good_name", "in_header", "sentence")


def features(blocks: list[tuple[str, int, int, int]]) -> np.ndarray:
    """A row of FEATURES for each block; a missing neighbour has no words and no links."""
    words = np.array([0, *[b[1] for b in blocks], 0], float)
    density = np.array([0, *[b[2] / b[1] for b in blocks], 0], float)
    flags = np.array([[b[3] & flag > 0 for flag in FLAGS] for b in blocks], float).reshape(-1, len(FLAGS))
    return np.column_stack([words[1:-1], density[1:-1], words[:-2], density[:-2], words[2:], density[2:], flags])


def labelled_table() -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of the blocks of the labelled layouts."""
    pages = [B.text_blocks(labelled_html(layout)) for layout in LAYOUTS]
    return np.vstack([features(blocks) for blocks in pages]), np.array([b[0].startswith("keep") for blocks in pages for b in blocks])


@cache
def trained_tree():
    return fit_tree(*labelled_table())


def with_blocks(pages: DataFrame, html: str = "html") -> DataFrame:
    """``row`` of each page with its blocks as arrays: texts, words, linked (words in links) and flags."""
    rows = pages.select(F.struct("*").alias("row"), F.col(html).alias("html"))
    schema = f"row {rows.schema['row'].dataType.simpleString()}, texts array<string>, words array<int>, linked array<int>, flags array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, found, size = 0, [], 0
            for place, page in enumerate(batch.column(1)):
                text = page.as_py()
                found.append(B.text_blocks(text))
                size += len(text or "")
                if size >= SLICE_CHARS or place + 1 == batch.num_rows:
                    lists = [pa.array([[b[i] for b in blocks] for blocks in found], pa.list_(kind))
                             for i, kind in enumerate((pa.string(), pa.int32(), pa.int32(), pa.int32()))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, len(found)), *lists],
                                                     names=["row", "texts", "words", "linked", "flags"])
                    begin, found, size = place + 1, [], 0

    return rows.mapInArrow(run, schema)


def _feature(number: int, place: Column) -> Column:
    """Feature ``number`` of the block at ``place`` of the arrays made by ``with_blocks``."""
    name = FEATURES[number]
    if number >= 6:
        return F.get("flags", place).bitwiseAND(F.lit(FLAGS[number - 6])).cast("boolean").cast("int")
    place = place - 1 if name.endswith("before") else place + 1 if name.endswith("after") else place
    words = F.get("words", place)
    return F.coalesce(words if name.startswith("words") else F.get("linked", place) / words, F.lit(0))


def main_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Each row of ``pages`` as struct ``row``, with ``main_text``: the blocks that the tree takes for main text, one a line.

    A page is cut into flat blocks at block-level tags. A block has its words and link density, those of the blocks
    before and after it, and flags for what its elements say: a heading, inside nav, footer, aside or form, inside an
    article, or inside an element whose class or id names such a part. A tree, trained when first used on the
    labelled layouts of ``labelled_pages``, says which blocks are main text; it runs as a Spark expression. No rows are
    moved between tasks and no page's text is cut.

    Character references are decoded, white space (also no-break spaces and br) becomes one space. Text inside script,
    style, title, textarea, template, svg, iframe and noscript is no block; a comment or script that is not closed lasts to the
    end of the page. A null or empty page, and one without main text, gives "". Repeated rows come back each, all
    columns stay in ``row`` whatever their names, an empty table gives an empty result.
    """
    tree = trained_tree()
    kept = F.filter("texts", lambda text, place: expression(tree, lambda number: _feature(number, place)))
    return with_blocks(pages, html).select("row", F.array_join(kept, "\n").alias("main_text"))
