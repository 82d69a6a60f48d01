"""Staged column expressions.

Grid geometry needs intermediate values that are used many times over.  Nesting
them in one expression would repeat the work at each use, so a computation is a
list of *steps*, each a ``{column: SQL expression}`` dict that may read the
columns of earlier steps.  Every step becomes one ``Project``; they all run
inside the same generated-code stage, with no shuffle and no Python.

The same list of steps can be compiled into projections over a DataFrame (``run``) or into
one expression with the steps bound by lambdas (``as_lambda``); a job run on ``Inline``
in place of a table becomes such an expression.
"""
import re
from itertools import count

from pyspark.sql import DataFrame

_serial = count()


def fresh(stem="t"):
    """A column prefix that no table has."""
    return f"_hx{next(_serial)}_{stem}_"


def number(x):
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, int):
        return f"{x}L" if abs(x) >= 2 ** 31 else str(x)
    return f"{x!r}D"


def pick(values, index):
    """Entry ``index`` (from 0) of a constant list; 0 outside it.

    Never NULL: with non-nullable inputs the generated code carries no null
    checks, which keeps methods below the size HotSpot stops compiling at.
    Callers guard the final result instead.
    """
    zero, kind = ("0D", "double") if isinstance(values[0], float) else (
        ("0L", "bigint") if max(map(abs, values)) >= 2 ** 31 else ("0", "int"))
    # Written as text that the optimizer folds into one array literal: as array(...) the
    # table would be a node per entry in every analysis pass.
    table = f"from_json('[{','.join(map(repr, values))}]', 'array<{kind}>')"
    return f"coalesce(get({table}, {index}), {zero})"


def whole(x):
    """A whole DOUBLE or BIGINT as INT; never NULL for non-NULL input (casts are
    declared nullable, which would add null checks downstream)."""
    return f"coalesce(CAST({x} AS INT), 0)"


def floor(x):
    return f"coalesce(floor({x}), 0L)"


_constants = re.compile(r"from_json\('[^']*', '[^']*'\)")
# Rough budget, in characters of expression, for what one generated method may hold
# and still be compiled by HotSpot (8000 bytes of bytecode).
METHOD_BUDGET = 3400


def weight(step):
    return sum(len(_constants.sub("", e)) for e in step.values())


def end_stage(df: DataFrame, column) -> DataFrame:
    """End a generated-code stage, passing rows on unchanged: a generator over a
    lambda is not code-generated."""
    unit = fresh("cut")
    if isinstance(df, Statement):
        return df.then([*df.columns, unit], "*", f"explode(transform(array({column}), x -> 0)) AS {unit}").then(df.columns, *df.columns)
    return df.selectExpr("*", f"explode(transform(array({column}), x -> 0)) AS {unit}").drop(unit)


def project(df: DataFrame, steps) -> DataFrame:
    """One projection per step.

    Long chains are cut into several generated-code stages: HotSpot does not compile
    methods over 8000 bytes, and running each projection on its own instead nests
    hundreds of iterators.
    """
    if isinstance(df, Inline):
        return df.plus([n for step in steps for n in step], list(steps))
    spent, last = 0, None
    for step in steps:
        if spent and spent + weight(step) > METHOD_BUDGET:
            df, spent = end_stage(df, last), 0
        made = [f"{e} AS `{n}`" for n, e in step.items()]
        df = df.then([*df.columns, *step], "*", *made) if isinstance(df, Statement) else df.selectExpr("*", *made)
        spent += weight(step)
        last = f"`{next(iter(step))}`"
    return df


def run(df: DataFrame, steps, outputs, drop=(), first=False) -> DataFrame:
    """Apply the steps and keep the input columns plus ``outputs`` (name -> expression);
    an output replaces an input column of the same name.

    Long step lists start a generated-code stage of their own, unless ``first`` says
    that what comes before is only a scan.
    """
    if isinstance(df, Inline):
        return df.plus(outputs, [*steps, outputs])
    kept = [f"`{c}`" for c in df.columns if c not in outputs and c not in drop]
    if not steps:
        return df.selectExpr(*kept, *[f"{e} AS `{n}`" for n, e in outputs.items()])
    if not first and sum(map(weight, steps)) > METHOD_BUDGET / 2:
        df = end_stage(df, f"`{df.columns[0]}`")
    df = project(df, steps)
    # Handing the results through a one-element generator keeps the optimizer from
    # substituting the steps back into a filter or join condition on the outputs
    # (which multiplies them out); filters on the input columns still pass below it.
    fields = ", ".join(f"'{n}', {e}" for n, e in outputs.items())
    return df.selectExpr(*kept, f"inline(array(named_struct({fields})))")


def keep_if(df: DataFrame, condition) -> DataFrame:
    """Filter on step columns without letting the optimizer move the condition below
    the steps (see ``run``)."""
    if isinstance(df, Inline):
        return df.plus([], condition)
    flag = fresh("keep")
    if isinstance(df, Statement):
        return fence(df, df.columns, {flag: condition}).where(flag).then(df.columns, *df.columns)
    return df.selectExpr("*", f"inline(array(named_struct('{flag}', {condition})))").filter(flag).drop(flag)


_word = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


def _mentions(expr, names):
    return {w for w in _word.findall(expr) if w in names}


def _levels(steps, wanted):
    """The steps that ``wanted`` needs, as few levels as their reading order allows."""
    exprs = {n: e for step in steps for n, e in step.items()}
    needed, todo = set(), _mentions(wanted, exprs)
    while todo:
        n = todo.pop()
        needed.add(n)
        todo |= _mentions(exprs[n], exprs) - needed
    level, out = {}, []
    for n, e in exprs.items():
        if n in needed:
            level[n] = 1 + max((level[m] for m in _mentions(e, exprs)), default=-1)
            while len(out) <= level[n]:
                out.append({})
            out[level[n]][n] = e
    return out


def as_lambda(steps, result):
    """One expression with the steps bound by nested lambdas, for use where projections
    are not available: in SQL functions and inside higher-order functions.

    A value is bound as the one element of an array. ``array_max`` takes the result out:
    the analyzer asks ``get`` and the like twice for their type, doubling at each level.
    """
    expr = result
    for step in reversed(_levels(steps, result)):
        v = fresh("v")
        name = {k: f"{v}{i}" for i, k in enumerate(step)}  # new ones: a later part may reuse a name
        expr = _word.sub(lambda m: f"{v}.{name[m.group(0)]}" if m.group(0) in name else m.group(0), expr)
        fields = ", ".join(f"'{name[k]}', {e}" for k, e in step.items())
        expr = f"array_max(transform(array(named_struct({fields})), {v} -> {expr}))"
    return expr


class Inline:
    """The parameters of one call in place of a table: a job of steps runs on it, and
    gives an expression instead of rows.  Parts are ``steps``, or (array, name) where
    the job makes a row of each element, or a condition that rows must meet."""

    def __init__(self, *columns, parts=()):
        self.columns, self.parts = list(columns), list(parts)

    def plus(self, columns, *parts):
        return Inline(*self.columns, *[c for c in columns if c not in self.columns], parts=[*self.parts, *parts])

    def drop(self, *names):
        return Inline(*[c for c in self.columns if c not in names], parts=self.parts)

    def value(self, result):
        """The result as one value; for jobs that keep one row a row."""
        return as_lambda([step for part in self.parts for step in part], result)

    def values(self, result):
        """The results of all rows, as an array."""
        expr, steps = f"array({result})", []
        for part in reversed(self.parts):
            if isinstance(part, list):
                steps = part + steps
                continue
            expr, steps = as_lambda(steps, expr), []
            if isinstance(part, tuple):
                expr = f"flatten(transform({part[0]}, {part[1]} -> {expr}))"
            else:
                expr = f"CASE WHEN {part} THEN {expr} ELSE array() END"
        return as_lambda(steps, expr)


class Statement:
    """The parameters of a call in place of a table, for a table function: a job of steps runs on it, and gives a
    chain of projections.  Under LATERAL Spark runs them on the distinct arguments, as generated code."""

    def __init__(self, text, columns):
        self.text, self.columns = text, list(columns)

    def then(self, columns, *expressions):
        return Statement(f"SELECT {', '.join(expressions)} FROM ({self.text})", columns)

    def where(self, condition):
        return Statement(f"SELECT * FROM ({self.text}) WHERE {condition}", self.columns)


def spread(df, array, name, keep=("*",)):
    """A row per element of an array."""
    if isinstance(df, Inline):
        return df.plus([name], (array, name))
    if isinstance(df, Statement):
        return df.then([*df.columns, name], "*", f"explode({array}) AS {name}")
    return df.selectExpr(*keep, f"explode({array}) AS {name}")


def fence(df, kept, fields):
    """The columns ``kept`` and new ones (name -> expression), through a generator, so that
    the optimizer doesn't move their steps (see ``run``)."""
    if isinstance(df, Inline):
        return df.plus(fields, [{n: e for n, e in fields.items() if n != e}])
    named = ", ".join(f"'{n}', {e}" for n, e in fields.items())
    if isinstance(df, Statement):
        return df.then([*kept, *fields], *kept, f"inline(array(named_struct({named})))")
    return df.selectExpr(*[f"`{c}`" for c in kept], f"inline(array(named_struct({named})))")


def scoped(steps, *results):
    """Rename the step columns so that two computations can share a table."""
    mine = {n for s in steps for n in s}
    p = fresh()

    def sub(e):
        return _word.sub(lambda m: p + m.group(0) if m.group(0) in mine else m.group(0), e)

    out = [{sub(n): sub(e) for n, e in s.items()} for s in steps]
    return (out, *[sub(r) for r in results])
