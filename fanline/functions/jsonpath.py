"""Compile a JSONPath filter expression into a boolean Spark Column.

A subscription may carry a ``filter-path`` such as
``$.event[?(@.props.k >= 50 && @.event_type == 'error')]``. An event matches
when evaluating the path over the whole envelope JSON returns a non-empty
result. The path is compiled once into built-in Column expressions over
VARIANT values, so a leaf keeps its JSON type and no Python runs per row.

Supported subset:

* container: ``$`` followed by ``.name`` / ``['name']`` / ``[*]`` segments
  (``[*]`` fans out over array elements or object values);
* a trailing filter ``[?( expr )]`` or a trailing wildcard ``[*]``;
* ``expr``: ``@.a.b OP literal``, ``literal OP @.a.b``, existence ``@.a.b``,
  ``!``, ``&&``, ``||``, parentheses; OP in ``== != < <= > >= =~ in nin``
  and the collection tests ``size empty contains anyof noneof subsetof``;
* literals: numbers, quoted strings, ``true``/``false``/``null``,
  ``/regex/flags`` (flag ``i``), ``[...]`` lists for ``in``/``nin``.

Types decide. Order comparisons hold between two numbers or two strings only.
Equality holds between equal types, and between a string and a number that
reads the same (``'60'`` and 60); null equals a present null only. A field that
is present exists, whatever its value, null included; a missing one equals
nothing. A regex reads strings, numbers and booleans as text, each element of
an array, and anything else, a missing field too, as the empty text.

A filter on an object tests that object; on an array it tests every element
and matches when any element does. Definite paths (no filter, no wildcard) and
anything else are rejected with ``JsonPathError``.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from decimal import Decimal, InvalidOperation

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


class JsonPathError(ValueError):
    pass


_TOKEN = re.compile(
    r"""
    \s*(?:
      (?P<num>-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)
     |(?P<str>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")
     |(?P<regex>/(?:[^/\\]|\\.)*/[a-z]*)
     |(?P<op>==|!=|<=|>=|=~|&&|\|\||<|>|!|\(|\)|\[|\]|,)
     |(?P<rel>@(?:\.[A-Za-z_$][\w$-]*|\['(?:[^'\\]|\\.)*'\])*)
     |(?P<word>[A-Za-z_]\w*)
    )""",
    re.VERBOSE,
)

#: quoted strings and regexes, whose dots are no path
_LITERAL = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|=~\s*/(?:[^/\\]|\\.)*/""")
_SEGMENT = re.compile(r"\.([A-Za-z_$][\w$-]*)|\['((?:[^'\\]|\\.)*)'\]|(\[\*\]|\.\*)")
WILDCARD = "*"


@dataclass(frozen=True)
class CompiledPath:
    """A parsed filter path: container segments plus a predicate AST."""

    text: str
    container: tuple[str, ...]
    kind: str  # "filter" | "wildcard"
    ast: tuple | None

    def leaves(self) -> set[tuple[str, ...]]:
        out: set[tuple[str, ...]] = set()

        def walk(n):
            if not n:
                return
            if n[0] == "rel":
                out.add(n[1])
            for c in n[1:]:
                if isinstance(c, tuple):
                    walk(c)

        walk(self.ast)
        return out


def _json_path(segments: tuple[str, ...]) -> str:
    """Spark ``get_json_object`` path text for a list of keys."""
    return "$" + "".join(f"['{s}']" if not re.fullmatch(r"[A-Za-z_]\w*", s) else f".{s}" for s in segments)


def _split_segments(text: str) -> tuple[str, ...]:
    out, pos = [], 0
    while pos < len(text):
        m = _SEGMENT.match(text, pos)
        if not m:
            raise JsonPathError(f"unsupported path segment at {pos}: {text!r}")
        out.append(m.group(1) if m.group(1) is not None else m.group(2) if m.group(2) is not None else WILDCARD)
        pos = m.end()
    return tuple(out)


def _tokens(expr: str) -> list[tuple[str, str]]:
    pos, out = 0, []
    while pos < len(expr):
        if expr[pos:].strip() == "":
            break
        m = _TOKEN.match(expr, pos)
        if not m or m.end() == pos:
            raise JsonPathError(f"cannot parse filter at {pos}: {expr!r}")
        kind = m.lastgroup
        out.append((kind, m.group(kind)))
        pos = m.end()
    return out


class _Parser:
    def __init__(self, toks):
        self.toks, self.i = toks, 0

    def peek(self):
        return self.toks[self.i] if self.i < len(self.toks) else (None, None)

    def take(self, value=None):
        t = self.peek()
        if t[0] is None or (value is not None and t[1] != value):
            raise JsonPathError(f"expected {value!r}, got {t[1]!r}")
        self.i += 1
        return t

    def parse(self):
        n = self.or_()
        if self.i != len(self.toks):
            raise JsonPathError(f"trailing tokens: {self.toks[self.i:]}")
        return n

    def or_(self):
        n = self.and_()
        while self.peek()[1] == "||":
            self.take()
            n = ("or", n, self.and_())
        return n

    def and_(self):
        n = self.unary()
        while self.peek()[1] == "&&":
            self.take()
            n = ("and", n, self.unary())
        return n

    def unary(self):
        if self.peek()[1] == "!":
            self.take()
            return ("not", self.unary())
        if self.peek()[1] == "(":
            self.take("(")
            n = self.or_()
            self.take(")")
            return n
        return self.comparison()

    def operand(self):
        kind, val = self.take()
        if kind == "rel":
            return ("rel", _split_segments(val[1:]))
        if kind == "num":
            return ("num", float(val) + 0.0, str(Decimal(val)))
        if kind == "str":
            body = val[1:-1]
            return ("str", re.sub(r"\\(.)", r"\1", body))
        if kind == "regex":
            end = val.rindex("/")
            flags = val[end + 1 :]
            if set(flags) - {"i"}:
                raise JsonPathError(f"unsupported regex flags {flags!r}")
            return ("regex", val[1:end], "i" in flags)
        if kind == "word" and val in ("true", "false"):
            return ("bool", val == "true")
        if kind == "word" and val == "null":
            return ("null",)
        if val == "[":
            items = []
            while self.peek()[1] != "]":
                items.append(self.operand())
                if self.peek()[1] == ",":
                    self.take(",")
            self.take("]")
            return ("list", tuple(items))
        raise JsonPathError(f"unexpected token {val!r}")

    def comparison(self):
        left = self.operand()
        kind, val = self.peek()
        if kind == "op" and val in ("==", "!=", "<", "<=", ">", ">=", "=~"):
            self.take()
            right = self.operand()
        elif kind == "word" and val in ("in", "nin", "size", "empty", "contains", "anyof", "noneof", "subsetof"):
            self.take()
            right = self.operand()
        else:
            if left[0] != "rel":
                raise JsonPathError("a bare literal is not a predicate")
            return ("exists", left)
        if left[0] != "rel" and right[0] == "rel":
            flip = {"<": ">", ">": "<", "<=": ">=", ">=": "<="}
            left, right, val = right, left, flip.get(val, val)
        if left[0] != "rel":
            raise JsonPathError("a comparison needs an @ path on one side")
        return ("cmp", val, left, right)


def _check(node) -> None:
    if node[0] == "cmp":
        check_literal(node[1], node[3])
    for c in node[1:]:
        if isinstance(c, tuple) and c and c[0] in ("and", "or", "not", "cmp"):
            _check(c)


def parse_path(text: str) -> CompiledPath:
    """Parse and validate a filter path (raises ``JsonPathError``)."""
    if text is None:
        raise JsonPathError("no path")
    s = text.strip()
    if not s.startswith("$"):
        raise JsonPathError(f"path must start with $: {text!r}")
    if ".." in _LITERAL.sub("", s):
        raise JsonPathError(f"deep scan is not supported: {text!r}")
    body = s[1:]
    if body.endswith("[*]"):
        return CompiledPath(text, _split_segments(body[:-3]), "wildcard", None)
    m = re.search(r"\[\?\((.*)\)\]$", body, re.S)
    if not m:
        raise JsonPathError(f"a definite path never yields an array; add a filter: {text!r}")
    container = _split_segments(body[: m.start()])
    ast = _Parser(_tokens(m.group(1))).parse()
    _check(ast)
    return CompiledPath(text, container, "filter", ast)


# ---------------------------------------------------------------------------
# Typed values: a leaf is a VARIANT, SQL NULL when it is missing

STRING, NUMBER, BOOLEAN, NULL, OTHER = "s", "n", "b", "z", "o"


def _type(v: Column) -> Column:
    # of parsed JSON: BIGINT, DECIMAL(p,s), DOUBLE, STRING, BOOLEAN, VOID, OBJECT<...>, ARRAY<...>
    return F.substring(F.schema_of_variant(v), 1, 2)


def is_number(v: Column) -> Column:
    return _type(v).isin("BI", "DE", "DO")


def is_string(v: Column) -> Column:
    return _type(v) == "ST"


def is_scalar(v: Column) -> Column:
    return _type(v).isin("ST", "BI", "DE", "DO", "BO")


def is_array(v: Column) -> Column:
    return _type(v) == "AR"


def kind_of(v: Column) -> Column:
    """The JSON type of a variant; NULL when it is missing."""
    kinds = {"ST": STRING, "BI": NUMBER, "DE": NUMBER, "DO": NUMBER, "BO": BOOLEAN, "VO": NULL, "OB": OTHER, "AR": OTHER}
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in kinds.items() for x in kv]), _type(v))


def text_of(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def number_of(v: Column) -> Column:
    # adding 0.0 makes one of the two zeros
    return F.try_variant_get(v, "$", "double") + F.lit(0.0)


def equality_key(kind: Column, number: Column, text: Column) -> Column:
    """What two values share exactly if they are equal."""
    return (
        F.when(kind == NUMBER, F.concat(F.lit("n:"), number.cast("string")))
        .when(kind == STRING, F.concat(F.lit("s:"), text))
        .when(kind == BOOLEAN, F.concat(F.lit("b:"), text))
        .when(kind == NULL, F.lit("z"))
    )


def value_key(v: Column) -> Column:
    return equality_key(kind_of(v), number_of(v), text_of(v))


def literal_values(node) -> list[tuple[str, float | None, str | None]]:
    """(kind, number, text) of every value that a literal equals: a string that reads
    as a number equals that number, a number equals its own text."""
    if node[0] == "num":
        return [(NUMBER, node[1], None), (STRING, None, node[2])]
    if node[0] == "str":
        out: list[tuple[str, float | None, str | None]] = [(STRING, None, node[1])]
        try:
            number = Decimal(node[1])
            return out + ([(NUMBER, float(number) + 0.0, None)] if number.is_finite() else [])
        except InvalidOperation:
            return out
    if node[0] == "bool":
        return [(BOOLEAN, None, "true" if node[1] else "false")]
    if node[0] == "null":
        return [(NULL, None, None)]
    raise JsonPathError(f"cannot compare with {node[0]}")


def _equals(v: Column, *literals) -> Column:
    values = [x for n in literals for x in literal_values(n)]
    of = {k: [n if k == NUMBER else t for kind, n, t in values if kind == k] for k in (STRING, NUMBER, BOOLEAN, NULL)}
    tests = {
        STRING: lambda: is_string(v) & text_of(v).isin(of[STRING]),
        NUMBER: lambda: is_number(v) & number_of(v).isin(of[NUMBER]),
        BOOLEAN: lambda: (_type(v) == "BO") & text_of(v).isin(of[BOOLEAN]),
        NULL: lambda: _type(v) == "VO",
    }
    any_of = F.lit(False)
    for kind, test in tests.items():
        if of[kind]:
            any_of = any_of | F.coalesce(test(), F.lit(False))
    return any_of


def elements_of(v: Column) -> Column:
    """The elements of an array; NULL for any other value."""
    return F.try_variant_get(v, "$", "array<variant>")


def regex_pattern(node) -> str:
    return ("(?i)" if node[2] else "") + r"\A(?:" + node[1] + r")\z"


def regex_matches(v: Column, pattern: str | Column) -> Column:
    """Scalars are read as text, of an array any element, anything else as empty."""

    def matches(x: Column) -> Column:
        return F.rlike(x, F.lit(pattern) if isinstance(pattern, str) else pattern)

    def read(x: Column) -> Column:
        return F.when(is_scalar(x), text_of(x)).otherwise(F.lit(""))

    inside = F.exists(elements_of(v), lambda e: matches(read(e)))
    return F.when(is_scalar(v), matches(text_of(v))).when(is_array(v), inside).otherwise(matches(F.lit("")))


def length_of(v: Column) -> Column:
    """Characters of a string, elements of an array, fields of an object; else NULL."""
    fields = F.try_variant_get(v, "$", "map<string,variant>")
    of = F.when(is_string(v), F.length(text_of(v)))
    return F.coalesce(of, F.size(F.when(elements_of(v).isNotNull(), elements_of(v))), F.when(fields.isNotNull(), F.size(fields)))


CHECKS = {"size": "num", "empty": "bool", "anyof": "list", "noneof": "list", "subsetof": "list", "in": "list", "nin": "list", "=~": "regex"}


def check_literal(op: str, right) -> None:
    """Refuse a literal that the operator cannot take."""
    if op in CHECKS and right[0] != CHECKS[op]:
        raise JsonPathError(f"{op} needs a {CHECKS[op]}")
    if op in ("<", "<=", ">", ">=") and right[0] not in ("num", "str"):
        raise JsonPathError(f"cannot order-compare with {right[0]}")
    if op in ("==", "!=", "contains"):
        literal_values(right)
    if right[0] == "list":
        for item in right[1]:
            literal_values(item)


def _compile(node, leaf) -> Column:
    """AST -> boolean Column, never NULL; ``leaf(segments)`` yields a variant."""
    op = node[0]
    if op == "and":
        return _compile(node[1], leaf) & _compile(node[2], leaf)
    if op == "or":
        return _compile(node[1], leaf) | _compile(node[2], leaf)
    if op == "not":
        return ~_compile(node[1], leaf)
    if op == "exists":
        return leaf(node[1][1]).isNotNull()
    _, cmp, left, right = node
    check_literal(cmp, right)
    v = leaf(left[1])
    if cmp == "=~":
        return F.coalesce(regex_matches(v, regex_pattern(right)), F.lit(False))
    if cmp in ("==", "!="):
        return _equals(v, right) if cmp == "==" else ~_equals(v, right)
    if cmp in ("in", "nin"):
        return _equals(v, *right[1]) if cmp == "in" else ~_equals(v, *right[1])
    if cmp in ("size", "empty", "contains", "anyof", "noneof", "subsetof"):
        return F.coalesce(_collection_op(cmp, v, right), F.lit(False))
    number = right[0] == "num"
    lhs, rhs = (number_of(v), F.lit(right[1])) if number else (text_of(v), F.lit(right[1]))
    test = {"<": lhs < rhs, "<=": lhs <= rhs, ">": lhs > rhs, ">=": lhs >= rhs}[cmp]
    return F.coalesce((is_number(v) if number else is_string(v)) & test, F.lit(False))


def _collection_op(cmp: str, v: Column, right) -> Column:
    """size / empty / contains / anyof / noneof / subsetof; NULL where they do not apply."""
    if cmp == "size":
        return length_of(v) == F.lit(int(right[1]))
    if cmp == "empty":
        return (length_of(v) == 0) == F.lit(right[1])
    elements = elements_of(v)
    if cmp == "contains":
        inside = F.exists(elements, lambda e: _equals(e, right))
        within = is_string(v) & text_of(v).contains(right[1]) if right[0] == "str" else F.lit(False)
        return F.when(elements.isNotNull(), inside).otherwise(within)
    if cmp == "subsetof":
        return F.forall(elements, lambda e: _equals(e, *right[1]))
    met = F.exists(elements, lambda e: _equals(e, *right[1]))
    return met if cmp == "anyof" else ~met


def path_predicate(path: str | CompiledPath, json_col: Column | str) -> Column:
    """Boolean (never NULL) Column: does ``path`` select anything in ``json_col``?"""
    cp = path if isinstance(path, CompiledPath) else parse_path(path)
    doc = F.col(json_col) if isinstance(json_col, str) else json_col
    return _through(F.try_parse_json(doc), cp.container, lambda c: _on_container(cp, c))


def fields_of(v: Column) -> Column:
    """The fields of an object; NULL for any other value."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _on_container(cp: CompiledPath, c: Column) -> Column:
    """The filter (or trailing wildcard) applied to one container."""
    elements, fields = elements_of(c), fields_of(c)
    if cp.kind == "wildcard":
        return F.coalesce(F.size(F.when(elements.isNotNull(), elements)) > 0, F.when(fields.isNotNull(), F.size(fields) > 0), F.lit(False))

    def leaf(base):
        return lambda segs: F.try_variant_get(base, _json_path(segs), "variant")

    each = F.exists(elements, lambda e: _compile(cp.ast, leaf(e)))
    return F.coalesce(F.when(elements.isNotNull(), each).when(fields.isNotNull(), _compile(cp.ast, leaf(c))), F.lit(False))


def _through(v: Column, segs: tuple[str, ...], final) -> Column:
    """Walk container segments; ``*`` fans out over array elements or object
    values with ``exists``, so the path matches if any branch does."""
    if WILDCARD not in segs:
        return final(v if not segs else F.try_variant_get(v, _json_path(segs), "variant"))
    i = segs.index(WILDCARD)
    c = v if i == 0 else F.try_variant_get(v, _json_path(segs[:i]), "variant")
    branches = F.coalesce(elements_of(c), F.map_values(fields_of(c)))
    return F.coalesce(F.exists(branches, lambda e: _through(e, segs[i + 1 :], final)), F.lit(False))


# ---------------------------------------------------------------------------
# Parse once: one ``from_json`` per document for all paths of a catalog


def doc_schema(paths) -> tuple[T.StructType | None, set[str]]:
    """A struct schema holding every container and leaf the filter paths read.

    Leaves are variants, which keep their JSON type. Paths whose fields would need two types (a node compared as a value and also
    descended into) are returned as ``slow`` and keep the per-path form.
    """
    tree: dict = {}
    slow: set[str] = set()
    leaf_mark = object()

    def insert(segs):
        node = tree
        for i, s in enumerate(segs):
            last = i == len(segs) - 1
            if any(k != s and k.lower() == s.lower() for k in node):
                return False  # struct fields that differ in case only are ambiguous to Spark
            cur = node.get(s)
            if last:
                if cur is None:
                    node[s] = leaf_mark
                elif cur is not leaf_mark:
                    return False
            else:
                if cur is leaf_mark:
                    return False
                node = node.setdefault(s, {})
        return True

    for cp in paths:
        if cp.kind != "filter" or not cp.container or WILDCARD in cp.container:
            slow.add(cp.text)
            continue
        snapshot = _copy_tree(tree, leaf_mark)
        # a filter on the element itself reads the container as a value
        ok = () not in cp.leaves() and all(insert(cp.container + leaf) for leaf in cp.leaves())
        if not ok or not cp.leaves():
            tree.clear()
            tree.update(snapshot)
            slow.add(cp.text)

    def to_type(node):
        if node is leaf_mark:
            return T.VariantType()
        return T.StructType([T.StructField(k, to_type(v)) for k, v in sorted(node.items())])

    return (to_type(tree) if tree else None), slow


def _copy_tree(node, leaf_mark):
    if node is leaf_mark:
        return node
    return {k: _copy_tree(v, leaf_mark) for k, v in node.items()}


def parsed_predicate(cp: CompiledPath, parsed: Column, doc: Column) -> Column:
    """``path_predicate`` reading leaves from the pre-parsed struct.

    When the container did not parse as an object (absent, an array, or a
    type clash somewhere in the document) the per-path form decides, so the
    result always equals ``path_predicate``.
    """
    container = parsed
    for s in cp.container:
        container = container.getField(s)

    def leaf(segs):
        c = container
        for s in segs:
            c = c.getField(s)
        return c

    fast = _compile(cp.ast, leaf)
    return F.when(container.isNotNull(), fast).otherwise(path_predicate(cp, doc))
