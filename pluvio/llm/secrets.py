"""Secret scan with multipart credential linking.

Base spans (assignments, access ids, hex runs) are found in every whole text. Weak
parts (identifiers, opaque strings, endpoints) say little alone; an interval join
within scopes reports them only where complementary parts lie near. Only DataFrame
functions run: matches come from regular expressions, positions from running sums of
the lengths of what lies between matches.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import store

#: Fixed patterns of the base spans (case-free letters where marked) and the least
#: length: of group 2 for assign, of the whole run for the others.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: Weak parts.
IDENTIFIER = r"""(?i)(?:access_?key_?id|client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
OPAQUE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"""(?i)(?:[a-z][a-z0-9+.-]*://[^\x00-\x20"'<>]+|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]+)?(?![0-9.]))"""

#: The next letter of a long run that is no scheme, and what of the run lies before it.
#: ENDPOINT would try each such letter as the start of a scheme and scan to the run's end.
NO_SCHEME = r"""(?i)(?:(?<![a-z0-9+.-])(?=[a-z0-9+.-]{64,}+(?!://[^\x00-\x20"'<>]))|\G(?<=[a-z]))([0-9+.-]*+)[a-z]"""

#: Kinds in the order in which they are listed.
KINDS = ("assign", "access", "hex", "identifier", "opaque", "endpoint")
BASE = 3
SCOPE = 200  # characters between parts that belong together


def _found(text: Column, pattern: str, keep=None) -> Column:
    """Array of (gap, len, keep) for the matches from left to right: ``gap`` is the
    number of characters since the match before. Null without matches."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def one(m, gap):
        return F.struct(F.length(gap).cast("long").alias("gap"), F.length(m).cast("long").alias("len"),
                        (keep(m) if keep else F.lit(True)).alias("keep"))
    # both are worked out once, not for every match; the gap after the last match has none
    return F.when(text.rlike(pattern), F.filter(F.zip_with(matches, gaps, one), lambda f: f["len"].isNotNull()))


def _without_long_runs(text: Column) -> Column:
    """``text`` with every letter of a long run that no :// ends replaced by _: ENDPOINT
    finds the same spans in it, in time that grows with the length and not its square."""
    return F.regexp_replace(text, F.lit(NO_SCHEME), F.lit("$1_"))


def _long_value(match: Column) -> Column:
    return F.length(F.regexp_extract(match, ASSIGN, 2)) >= 8


def _mixed(match: Column) -> Column:
    """Digits and both cases, or digits and 30 characters: unlike a word or a path."""
    return (match.rlike("[0-9]") & match.rlike("[A-Za-z]")
            & ((match.rlike("[A-Z]") & match.rlike("[a-z]")) | (F.length(match) >= 30)))


def parts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id) and their parts (row, kind, start, end): kind is the
    place in KINDS, positions count code points, end is exclusive."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    found = (_found(text, ASSIGN, _long_value), _found(text, ACCESS), _found(text, HEX),
             _found(text, IDENTIFIER), _found(text, OPAQUE, _mixed),
             # a lambda's argument is worked out once
             F.get(F.transform(F.array(_without_long_runs(text)), lambda t: _found(t, ENDPOINT)), F.lit(0)))
    # stored, so that row numbers are the same for all that read them
    rows = store(docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                             *[f.alias(k) for f, k in zip(found, KINDS, strict=True)]))
    each = None
    for i, k in enumerate(KINDS):
        one = (rows.filter(F.col(k).isNotNull()).select("row", F.lit(i).alias("kind"), F.posexplode(k).alias("n", "m"))
               .select("row", "kind", "n", "m.gap", "m.len", "m.keep"))
        each = one if each is None else each.union(one)
    # one document's matches of a kind make a window
    so_far = Window.partitionBy("row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (each.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(so_far))
              .filter("keep").select("row", "kind", (F.col("end") - F.col("len")).alias("start"), "end"))
    return rows.select("row", "doc_id"), placed


def link(placed: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak parts (row, kind, start, end) whose complement lies within ``scope``
    characters: an identifier needs a secret (assign, hex or opaque), an opaque string
    an identifier or access id, an endpoint both. A weak part that overlaps a base span
    is that span's and not reported. Parts meet in cells of the text, so a part is
    compared with what its neighbourhood can hold and nothing else."""
    cells = lambda a, b: F.explode(F.sequence(F.expr(f"({a}) div {scope}L"), F.expr(f"({b}) div {scope}L")))
    weak = (placed.filter(F.col("kind") >= BASE)
            .select("row", "kind", "start", "end",
                    cells(f"greatest(start - {scope}, 0)", f"end - 1 + {scope}").alias("cell")))
    near = placed.select(F.col("row").alias("_row"), F.col("kind").alias("_kind"), F.col("start").alias("_start"),
                         F.col("end").alias("_end"), cells("start", "end - 1").alias("_cell"))
    apart = F.greatest(F.col("_start") - F.col("end"), F.col("start") - F.col("_end"), F.lit(0))
    overlap = (F.col("_start") < F.col("end")) & (F.col("start") < F.col("_end"))
    other = F.col("_kind") != F.col("kind")
    met = weak.join(near, (F.col("row") == F.col("_row")) & (F.col("cell") == F.col("_cell")) & other & (apart <= scope))
    flags = met.groupBy("row", "kind", "start", "end").agg(
        F.max((F.col("_kind").isin(0, 2, 4) & ~overlap)).alias("secret"),
        F.max((F.col("_kind").isin(1, 3) & ~overlap)).alias("identifier"),
        F.max(((F.col("_kind") < BASE) & overlap)).alias("inside"))
    wanted = (F.when(F.col("kind") == 3, F.col("secret")).when(F.col("kind") == 4, F.col("identifier"))
              .otherwise(F.col("secret") & F.col("identifier")))
    return flags.filter(wanted & ~F.col("inside")).select("row", "kind", "start", "end")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, n_linked (long), and the
    spans as an array of (start, kind, end) ordered by start and kind. Null text counts
    as empty; repeated rows are scanned like any other; other columns of ``docs`` are
    not read."""
    rows, placed = parts(docs, id_col, text_col)
    placed = store(placed)
    every = placed.filter(F.col("kind") < BASE).union(link(placed, scope))
    span = F.struct("start", "kind", "end")
    of_row = every.groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return (rows.join(of_row, "row", "left").withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")))
            .select("doc_id", *[count(i).alias(f"n_{KINDS[i]}") for i in range(BASE)],
                    F.size(F.filter("spans", lambda s: s["kind"] >= BASE)).cast("long").alias("n_linked"), "spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["kind"] < BASE)
