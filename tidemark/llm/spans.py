"""Spans of regular expressions as arrays, without leaving the JVM.

Running sums and the like go in two levels (``running``), so that a text of n spans costs about n^1.5
small steps, and no expression looks at all of a text for each span. Expressions are SQL text over column names:
as deep as they nest, the driver would take longer to build them call by call than tasks to scan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EMPTY = "array<struct<start:bigint,end:bigint,hit:string>>"
FAR = 2**62


def bound(value: str, name: str, use: str) -> str:
    """``use`` with ``name`` standing for ``value``, which is worked out once."""
    return f"transform(array({value}), {name} -> {use})[0]"


def _chunks(values: str, name: str, use: str) -> str:
    """``use`` of each of about sqrt(n) slices, called ``name``, of ``values`` (itself a name), as an array."""
    size = f"cast(greatest(ceil(sqrt(size({values}))), 1) as int)"
    last = f"cast(greatest(ceil(size({values}) / chunk), 1) as int) - 1"
    return bound(size, "chunk", f"transform(sequence(0, {last}), k -> {bound(f'slice({values}, k * chunk + 1, chunk)', name, use)})")


def running(values: str, step: str, first: int) -> str:
    """Array of the ``step`` of all entries up to each of ``values`` (bigints), itself too.

    ``step`` is an associative expression of ``a`` and ``b``, and ``first`` its neutral value.
    """
    def fold(some: str) -> str:
        then = bound("acc.a", "a", bound(step, "y", "named_struct('a', y, 'out', concat(acc.out, array(y)))"))
        return f"aggregate({some}, named_struct('a', cast({first} as bigint), 'out', cast(array() as array<bigint>)), (acc, b) -> {then}, acc -> acc.out)"

    before = f"concat(array(cast({first} as bigint)), {fold('transform(parts, part -> element_at(part, -1))')})"
    whole = f"flatten(zip_with(parts, slice({before}, 1, size(parts)), (part, a) -> transform(part, b -> {step})))"
    return bound(values, "v", f"if(size(v) > 0, {bound(_chunks('v', 'some', fold('some')), 'parts', whole)}, cast(array() as array<bigint>))")


def beside_columns(docs: DataFrame, text: str, found: Callable[[DataFrame, str], DataFrame], added: tuple[str, ...]) -> DataFrame:
    """``docs`` and the columns ``added`` that ``found`` makes of it, which take the place of columns with their names, in either case.

    Meanwhile the columns of ``docs`` have names that no inner column has.
    """
    inner = {f"in_{i}": c for i, c in enumerate(docs.columns)}
    own = next(i for i, c in inner.items() if c.lower() == text.lower())
    names = {a.lower() for a in added}
    return found(docs.toDF(*inner), own).select(*[F.col(i).alias(c) for i, c in inner.items() if c.lower() not in names], *added)


def with_matches(df: DataFrame, out: str, text: str, pattern: str, if_any: Column, keep: Callable[[Column], Column] | None = None, ahead: int | None = None) -> DataFrame:
    """Add ``out``: leftmost non-overlapping matches as (start, end, hit), in code points.

    ``pattern`` must match no empty string, and only texts with ``if_any`` are
    scanned. ``keep`` judges the matched string. Matches and the pieces
    between them come from the same scan rule, so adding up their lengths gives
    the places. With ``ahead``, the hit is group 1, in a look-ahead, and a match
    takes in only so many code points: hits may overlap.
    """
    none = F.lit(None)
    m, p = f"_{out}_m", f"_{out}_p"
    df = df.withColumn(m, F.when(if_any, F.regexp_extract_all(text, F.lit(pattern), F.lit(0 if ahead is None else 1))).otherwise(none))
    df = df.withColumn(p, F.when(F.size(m) > 0, F.split(F.col(text), pattern, -1)).otherwise(none))
    taken = "length(hit)" if ahead is None else str(ahead)
    ends = running(f"zip_with({m}, slice({p}, 1, size({m})), (hit, gap) -> cast(length(gap) + {taken} as bigint))", "a + b", 0)
    placed = F.expr(f"zip_with({m}, {ends}, (hit, e) -> named_struct('start', e - {taken}, 'end', e - {taken} + length(hit), 'hit', hit))")
    return df.withColumn(out, F.when(F.size(p) > 0, F.filter(placed, lambda x: keep(x["hit"])) if keep else placed).otherwise(F.array().cast(EMPTY))).drop(m, p)


def beside(spans: str, others: str) -> str:
    """``spans`` by start, each with the largest end of ``others`` that start before it and the smallest start of those after: (span, before, after).

    What starts with the span stands on one side or the other. Of ``others`` only start and end count.
    """
    def mark(who: str, own: str, span: str) -> str:
        return f"transform({who}, x -> named_struct('start', x.start, 'own', {own}, 'end', x.end, 'span', {span}))"

    ends = running(f"transform(rows, x -> if(x.own, -{FAR}L, x.end))", "greatest(a, b)", -FAR)
    starts = f"reverse({running(f'reverse(transform(rows, x -> if(x.own, {FAR}L, x.start)))', 'least(a, b)', FAR)})"
    looked = (
        f"filter(zip_with(zip_with(rows, {ends}, (x, e) -> named_struct('span', x.span, 'before', e, 'own', x.own)), {starts},"
        " (y, s) -> named_struct('span', y.span, 'before', y.before, 'after', s, 'own', y.own)), r -> r.own)")
    alone = f"transform({spans}, x -> named_struct('span', x, 'before', -{FAR}L, 'after', {FAR}L, 'own', true))"
    rows = f"sort_array(concat({mark(spans, 'true', 'x')}, {mark(others, 'false', f'get({spans}, {2**31 - 1})')}))"
    return f"if(size({spans}) = 0 or size({others}) = 0, {alone}, {bound(rows, 'rows', looked)})"


def apart_from(spans: str, others: str) -> Column:
    """Those of column ``spans`` that overlap none of column ``others``."""
    return F.expr(f"transform(filter({beside(spans, others)}, r -> r.before <= r.span.start and r.after >= r.span.end), r -> r.span)")


def labelled(spans: str, kind: str) -> str:
    return f"transform({spans}, x -> named_struct('kind', '{kind}', 'start', x.start, 'end', x.end))"


def joined(spans: str) -> Column:
    """kind:start:end, joined by commas."""
    return F.expr(f"array_join(transform({spans}, x -> concat_ws(':', x.kind, cast(x.start as string), cast(x.end as string))), ',')")


def replaced(text: str, spans: str, label: str) -> Column:
    """``text`` with the union of ``spans`` replaced; ``label``, of ``kind``, names a run of overlapping spans by its first."""
    cut = lambda t, at, n: f"substring({t}, cast({at} + 1 as int), cast({n} as int))"
    # A slice of runs is cut from the text at once, then each run from that.
    each = f"transform(some, h -> concat({cut('t', 'h.gap - some[0].gap', 'h.start - h.gap')}, {bound('h.kind', 'kind', label)}))"
    piece = bound(cut(text, "some[0].gap", "element_at(some, -1).start - some[0].gap"), "t", f"array_join({each}, '')")
    rest = cut(text, "element_at(ends, -1)", 2**31 - 1)
    heads = "filter(zip_with(rows, slice(ends, 1, size(rows)), (x, e) -> named_struct('gap', e, 'start', x.start, 'kind', x.kind)), h -> h.gap <= h.start)"
    ends = f"concat(array(0L), {running('transform(rows, x -> -x.back)', 'greatest(a, b)', 0)})"
    rows = f"sort_array(transform({spans}, x -> named_struct('start', x.start, 'back', -x.end, 'kind', x.kind)))"
    joined_up = f"concat(array_join({_chunks('heads', 'some', piece)}, ''), {rest})"
    return F.expr(f"if(size({spans}) > 0, {bound(rows, 'rows', bound(ends, 'ends', bound(heads, 'heads', joined_up)))}, {text})")
