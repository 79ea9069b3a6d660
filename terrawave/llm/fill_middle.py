"""Fill-in-the-middle: texts cut at line ends into prefix, middle and suffix, and put in another order with marks.

One full match of (unit)* by the regex library keeps the end of every repetition; these ends are all places where a text
may be cut. Cuts, form and order come from a hash of the id, so reruns agree. Rows that share an id share their random
numbers. A null text is the empty one, whose form is plain, and a null id is the empty string in the hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrawave.llm.text import slices

UNITS = regex.compile(r"([^\n]*+\n|[^\n]++)*")
MARKS = ("<P>", "<S>", "<M>")  # before prefix, suffix and middle
SEED, RATE, SPM = 7, 100, 50  # seed of the hash; of 100 texts so many are cut, and of those so many with the suffix first


def ends(text: str) -> list[int]:
    """The end of each line of a text."""
    return UNITS.fullmatch(text).ends(1)


def cut(text: str, name: str, seed: int = SEED, rate: int = RATE, spm: int = SPM, marks: tuple[str, str, str] = MARKS) -> tuple[int, str, int | None, int | None, str]:
    """Number of lines, form, characters of prefix and middle (None if plain), and output, for a text with this id."""
    at = ends(text)
    n = len(at)
    digest = hashlib.sha256(f"{seed}:{name}".encode()).digest()
    h1, h2, h3, h4 = (int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return n, "plain", None, None, text
    a, b = (at[i - 1] if i else 0 for i in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    p, s, m = marks
    if h4 % 100 < spm:
        return n, "spm", a, b - a, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", a, b - a, f"{p}{prefix}{s}{suffix}{m}{middle}"


def transformed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc (a struct of all columns of docs), n, form, prefix_chars, middle_chars, output; options are those of `cut`."""
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("source_text"))
    schema = rows.select("doc").schema.add("n", "long").add("form", "string").add("prefix_chars", "long").add("middle_chars", "long").add("output", "string")
    kinds = {"n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "output": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for part in slices(texts):
                made = zip(*(cut(t, i, **options) for t, i in zip(texts[part], names[part], strict=True)), strict=True)
                columns = [pa.array(v, k) for v, k in zip(made, kinds.values(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, part.stop - part.start), *columns], ["doc", *kinds])

    return rows.mapInArrow(run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text that an output of this form was made of; a text that holds a mark is plain, so each mark is found once."""
    p, s, m = map(F.lit, marks)

    def between(a: Column, b: Column) -> Column:
        return F.split_part(F.split_part(output, a, F.lit(2)), b, F.lit(1))

    middle = F.split_part(output, m, F.lit(2))
    return F.when(form == "psm", F.concat(between(p, s), middle, between(s, m))).when(form == "spm", F.concat(between(p, m), middle, between(s, p))).otherwise(output)


#: The rows of op12, for DuckDB.
ORACLE = r"""
WITH base AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (
  SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM base),
ranked AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM cut),
parts AS (
  SELECT doc_id, t, n, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS p, coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS m, coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM ranked)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN t ELSE p || m || s END) AS restored_sha256
FROM parts
"""
