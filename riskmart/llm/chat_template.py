"""Chat formatting by a compiled template.

A small template language is parsed into a syntax tree, constants are folded, and
the tree becomes nested Python closures; nothing of a template is ever evaluated as
Python.  The language:

* text; ``{{ expression }}``; ``{% set name = expression %}``
* ``{% if e %} .. {% elif e %} .. {% else %} .. {% endif %}``
* ``{% for name in e %} .. {% endfor %}``, with ``loop.first``, ``loop.last``, ``loop.index0``
* ``{% generation %} .. {% endgeneration %}``: what is rendered inside is under the loss mask
* expressions: strings, integers, true, false, names, ``a.b`` (keys of a mapping only),
  ``or and not == != in + ( )`` and the filters of ``FILTERS`` after ``|``

``escape`` makes any text safe: a backslash doubles, and every control string gets a
backslash after its first character; ``unescape`` drops each backslash and keeps the
character after it.

Defined cases: a null text or role is empty; turns go by number, then role, then
text, nulls first; rows that repeat are turns of their own; a null conversation id is
a conversation; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, is_dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import stash

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ANS]", "[TURN]", "[:]", "[/TURN]")
TEMPLATE = ("{{ '<' + 's>' }}{% for m in messages %}"
            "{% if m.role == 'system' %}<<SYS>>{{ m.text|escape }}<</SYS>>"
            "{% elif m.role == 'user' %}[INST]{{ m.text|escape }}[/INST]"
            "{% elif m.role == 'assistant' %}[ANS]{% generation %}{{ m.text|escape }}{% endgeneration %}</s>"
            "{% else %}[TURN]{{ m.role|escape }}[:]{{ m.text|escape }}[/TURN]{% endif %}{% endfor %}")

_CONTROL = re.compile("|".join(map(re.escape, ("\\", *CONTROLS))))
_ESCAPED = re.compile(r"\\(.)", re.S)


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else f"{m[0][0]}\\{m[0][1:]}", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}


# -- syntax tree ------------------------------------------------------------------------

@dataclass
class Const:
    value: object


@dataclass
class Name:
    name: str


@dataclass
class Key:
    of: object
    key: str


@dataclass
class Op:
    op: str
    args: list


@dataclass
class Out:
    value: object


@dataclass
class Set:
    name: str
    value: object


@dataclass
class If:
    tests: list                       # of (condition, body)
    rest: list = field(default_factory=list)


@dataclass
class For:
    name: str
    of: object
    body: list


@dataclass
class Generation:
    body: list


class TemplateError(ValueError):
    pass


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.+()]))")


class Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, text: str):
        self.tokens, at = [], 0
        while text[at:].strip():
            m = _TOKEN.match(text, at)
            if not m:
                raise TemplateError(f"unreadable expression: {text[at:]!r}")
            kind = ("string", "number", "name", "sign")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self):
        out = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return out

    def either(self):
        out = self.both()
        while self.take("or"):
            out = Op("or", [out, self.both()])
        return out

    def both(self):
        out = self.negated()
        while self.take("and"):
            out = Op("and", [out, self.negated()])
        return out

    def negated(self):
        return Op("not", [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        out = self.added()
        while op := self.take("==", "!=", "in"):
            out = Op(op, [out, self.added()])
        return out

    def added(self):
        out = self.filtered()
        while self.take("+"):
            out = Op("+", [out, self.filtered()])
        return out

    def filtered(self):
        out = self.item()
        while sign := self.take("|", "."):
            kind, name = self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")
            if kind != "name":
                raise TemplateError(f"a name must follow {sign!r}")
            self.at += 1
            if sign == "|" and name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            out = Op("|" + name, [out]) if sign == "|" else Key(out, name)
        return out

    def item(self):
        if self.take("("):
            out = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return out
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "string":
            return Const(_ESCAPED.sub(lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1]))
        if kind == "number":
            return Const(int(value))
        if kind == "name":
            return Const(value == "true") if value in ("true", "false") else Name(value)
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> list:
    """The template's statements."""
    pieces, at = [], 0
    for m in _TAG.finditer(template):
        if m.start() > at:
            pieces.append(("text", template[at: m.start()]))
        pieces.append(("out", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    if template[at:]:
        pieces.append(("text", template[at:]))
    pieces.reverse()

    def body(*ends: str) -> tuple[list, str]:
        out = []
        while pieces:
            kind, value = pieces.pop()
            if kind == "text":
                out.append(Out(Const(value)))
                continue
            if kind == "out":
                out.append(Out(Expression(value).whole()))
                continue
            word, _, rest = value.partition(" ")
            if word in ends:
                return out, value
            if word == "set" and (m := re.fullmatch(r"\s*(\w+)\s*=(.*)", rest, re.S)):
                out.append(Set(m[1], Expression(m[2]).whole()))
            elif word == "for" and (m := re.fullmatch(r"\s*(\w+)\s+in\s+(.*)", rest, re.S)):
                out.append(For(m[1], Expression(m[2]).whole(), body("endfor")[0]))
            elif word == "generation":
                out.append(Generation(body("endgeneration")[0]))
            elif word == "if":
                node, test = If([]), rest
                while True:
                    inner, end = body("elif", "else", "endif")
                    node.tests.append((Expression(test).whole(), inner))
                    if end.startswith("elif"):
                        test = end[4:]
                        continue
                    if end == "else":
                        node.rest = body("endif")[0]
                    break
                out.append(node)
            else:
                raise TemplateError(f"unknown tag {value!r}")
        if ends:
            raise TemplateError(f"missing {ends[-1]}")
        return out, ""

    return body()[0]


_OPS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: a in b, "not": lambda a: not a,
    "+": lambda a, b: a + b if isinstance(a, int) and isinstance(b, int) else str(a) + str(b),
    **{"|" + k: (lambda f: lambda a: f(str(a)))(f) for k, f in FILTERS.items()}}


def folded(node):
    """An expression with its constant parts worked out."""
    if isinstance(node, Key):
        return Key(folded(node.of), node.key)
    if not isinstance(node, Op):
        return node
    args = [folded(a) for a in node.args]
    if node.op in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (node.op == "and") else args[0]
    if node.op in _OPS and all(isinstance(a, Const) for a in args):
        return Const(_OPS[node.op](*(a.value for a in args)))
    return Op(node.op, args)


def fold(body: list) -> list:
    """Statements with constants folded: dead branches go, neighbouring texts become one."""
    out: list = []
    for node in body:
        if isinstance(node, Out):
            value = folded(node.value)
            if isinstance(value, Const) and out and isinstance(out[-1], Out) and isinstance(out[-1].value, Const):
                out[-1] = Out(Const(str(out[-1].value.value) + str(value.value)))
            else:
                out.append(Out(value))
        elif isinstance(node, Set):
            out.append(Set(node.name, folded(node.value)))
        elif isinstance(node, For):
            out.append(For(node.name, folded(node.of), fold(node.body)))
        elif isinstance(node, Generation):
            out.append(Generation(fold(node.body)))
        else:
            tests, rest = [], fold(node.rest)
            for test, inner in node.tests:
                test = folded(test)
                if isinstance(test, Const) and not test.value:
                    continue
                if isinstance(test, Const):
                    rest = fold(inner)
                    break
                tests.append((test, fold(inner)))
            out.extend([If(tests, rest)] if tests else rest)
    return out


# -- closures ---------------------------------------------------------------------------

class Sink:
    """Rendered text and the spans of it (code points) that are under the loss mask."""

    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


def _value(node) -> Callable[[dict], object]:
    if isinstance(node, Const):
        return lambda env, v=node.value: v
    if isinstance(node, Name):
        def look(env, name=node.name):
            if name not in env:
                raise TemplateError(f"no name {name!r}")
            return env[name]
        return look
    if isinstance(node, Key):
        def pick(env, of=_value(node.of), key=node.key):
            found = of(env)
            if not isinstance(found, dict) or key not in found:
                raise TemplateError(f"no key {key!r}")
            return found[key]
        return pick
    args = [_value(a) for a in node.args]
    if node.op == "and":
        return lambda env: args[0](env) and args[1](env)
    if node.op == "or":
        return lambda env: args[0](env) or args[1](env)
    if len(args) == 1:
        return lambda env, f=_OPS[node.op], a=args[0]: f(a(env))
    return lambda env, f=_OPS[node.op], a=args[0], b=args[1]: f(a(env), b(env))


def _statement(node) -> Callable[[dict, Sink], None]:
    if isinstance(node, Out) and isinstance(node.value, Const):
        return lambda env, out, text=str(node.value.value): out.put(text)
    if isinstance(node, Out):
        return lambda env, out, f=_value(node.value): out.put(str(f(env)))
    if isinstance(node, Set):
        def assign(env, out, f=_value(node.value), name=node.name):
            env[name] = f(env)
        return assign
    if isinstance(node, Generation):
        def marked(env, out, run=_block(node.body)):
            start = out.length
            run(env, out)
            if out.length > start:
                out.spans.append((start, out.length))
        return marked
    if isinstance(node, For):
        def loop(env, out, of=_value(node.of), run=_block(node.body), name=node.name):
            rows = list(of(env))
            for i, row in enumerate(rows):
                run({**env, name: row, "loop": {"index0": i, "first": i == 0, "last": i == len(rows) - 1}}, out)
        return loop

    def choose(env, out, tests=[(_value(t), _block(b)) for t, b in node.tests], rest=_block(node.rest)):
        for test, run in tests:
            if test(env):
                return run(env, out)
        return rest(env, out)
    return choose


def _block(body: list) -> Callable[[dict, Sink], None]:
    steps = [_statement(n) for n in body]

    def run(env, out):
        for step in steps:
            step(env, out)
    return run


def compile_template(template: str) -> Callable[[list[dict]], tuple[str, list[tuple[int, int]]]]:
    """A renderer: messages (role, text) -> formatted text and the spans under the loss mask."""
    run = _block(fold(parse(template)))

    def render(messages: list[dict]) -> tuple[str, list[tuple[int, int]]]:
        out = Sink()
        run({"messages": messages}, out)
        return "".join(out.parts), out.spans
    return render


# -- the jobs ---------------------------------------------------------------------------

_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FORMATTED = "conv_id long, block long, formatted string, mask array<struct<start:long,end:long>>, opens boolean, closes boolean"
_RENDERED = ("conv_id long, part int, block int, formatted string, mask array<struct<start:long,end:long>>, "
             "opens boolean, closes boolean, edge int")
BLOCK_CHARS = 1 << 18           # formatted characters after which a conversation goes on in a new row


def _names(node) -> set[str]:
    """Every name that occurs in a part of a syntax tree."""
    if isinstance(node, (list, tuple)):
        return set().union(*map(_names, node)) if node else set()
    if isinstance(node, Name):
        return {node.name}
    return _names([getattr(node, f) for f in node.__dataclass_fields__]) if is_dataclass(node) else set()


def streamed(template: str) -> tuple[str, Callable[[dict, Sink], None], str, str] | None:
    """(text before, renderer of one message, its name, text after) of a template that is one loop over all messages
    between constant texts, with no look at other messages; None of any other."""
    body = fold(parse(template))
    loops = [k for k, n in enumerate(body) if isinstance(n, For)]
    if len(loops) != 1:
        return None
    loop, around = body[loops[0]], [*body[:loops[0]], *body[loops[0] + 1:]]
    if not all(isinstance(n, Out) and isinstance(n.value, Const) for n in around):
        return None
    if not (isinstance(loop.of, Name) and loop.of.name == "messages") or _names(loop.body) - {loop.name}:
        return None
    text = lambda nodes: "".join(str(n.value.value) for n in nodes)
    return text(body[:loops[0]]), _block(loop.body), loop.name, text(body[loops[0] + 1:])


def _batch_of(rows: list[dict], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema(fields))


def _whole(template: str):
    """Conversations in one row each, for templates that look at all messages."""
    fields = [("conv_id", pa.int64()), ("block", pa.int64()), ("formatted", pa.string()), ("mask", _SPANS),
              ("opens", pa.bool_()), ("closes", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render, now, held = compile_template(template), None, []

        def done() -> dict:
            text, spans = render(held)
            return {"conv_id": now[0], "block": 0, "formatted": text, "opens": True, "closes": True,
                    "mask": [{"start": a, "end": b} for a, b in spans]}

        rows, size = [], 0
        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if now is not None and now[0] != conv:
                    rows.append(done())
                    size += len(rows[-1]["formatted"])
                    held = []
                    if size > 1 << 22:
                        yield _batch_of(rows, fields)
                        rows, size = [], 0
                now = (conv,)
                held.append({"role": role, "text": text})
        if now is not None:
            rows.append(done())
        yield _batch_of(rows, fields)
    return run


def _blocks(template: str, chars: int):
    """Runs of a conversation's messages, of about ``chars`` characters each, as they come sorted to a task.

    ``edge``: 1 on a task's first row and 2 on its last, whose conversations may begin or go on elsewhere.
    """
    fields = [("conv_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("formatted", pa.string()),
              ("mask", _SPANS), ("opens", pa.bool_()), ("closes", pa.bool_()), ("edge", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, render, name, _ = streamed(template)
        part, number, now, out, opens = TaskContext.get().partitionId(), 0, None, Sink(), True
        ready, size = [], 0

        def close(closes: bool) -> None:
            nonlocal number, out, opens, size
            ready.append({"conv_id": now[0], "part": part, "block": number, "formatted": "".join(out.parts),
                          "mask": [{"start": a, "end": b} for a, b in out.spans], "opens": opens, "closes": closes,
                          "edge": int(number == 0)})
            number, size, out, opens = number + 1, size + out.length, Sink(), closes

        for batch in batches:
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if now is not None and now[0] != conv:
                    close(True)
                elif out.length > chars:
                    close(False)
                now = (conv,)
                render({name: {"role": role, "text": text}}, out)
                if size > 1 << 22:              # the last row stays: it may be the task's last
                    yield _batch_of(ready[:-1], fields)
                    ready, size = ready[-1:], 0
        if now is not None:
            close(True)
            ready[-1]["edge"] += 2
        yield _batch_of(ready, fields)
    return run


def formatted(conversations: DataFrame, template: str = TEMPLATE, chars: int = BLOCK_CHARS) -> DataFrame:
    """(conv_id, block, formatted, mask, opens, closes) of all conversations (rows conv_id, turn, role, text).

    A conversation's text is that of its blocks in their order; the mask counts from each
    block's start.  Messages are range-partitioned by conversation and turn, so a conversation
    of very many is shared by several tasks and none holds more than a block of it.  (A
    template that looks at other messages, or at the loop's state, needs its conversations
    whole: there each is one block, in one task's memory.)
    """
    compile_template(template)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    order = ["conv_id", "turn", "role", "text"]
    shape = streamed(template)
    if shape is None:
        return rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(_whole(template), FORMATTED)
    found = stash(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        _blocks(template, chars), _RENDERED), "chat-blocks")
    # two rows a task at most: which conversations go on from task to task
    edges = sorted((r["part"], r["edge"], r["conv_id"]) for r in found.where("edge > 0").select(
        "part", "edge", "conv_id").collect())
    ends = [(p, next(c for q, e, c in edges if q == p and e & 1), next(c for q, e, c in edges if q == p and e & 2))
            for p in dict.fromkeys(p for p, _, _ in edges)]
    goes_on = [a[2] == b[1] for a, b in zip(ends, ends[1:])]
    facts = [(p, not (k and goes_on[k - 1]), not (k < len(goes_on) and goes_on[k])) for k, (p, _, _) in enumerate(ends)]
    facts = F.broadcast(found.sparkSession.createDataFrame(facts, "part int, first_opens boolean, last_closes boolean"))
    before, _, _, after = shape
    opens = F.col("opens") & ((F.col("edge").bitwiseAND(1) == 0) | F.col("first_opens"))
    closes = F.col("closes") & ((F.col("edge").bitwiseAND(2) == 0) | F.col("last_closes"))
    # the first conversation of a task has its first block only at the task's start
    rows = found.join(facts, "part").withColumns({"opens": opens, "closes": closes})
    shift = F.when(F.col("opens"), F.lit(len(before))).otherwise(F.lit(0)).cast("long")
    return rows.select(
        "conv_id", (F.shiftleft(F.col("part").cast("long"), 32) + F.col("block")).alias("block"),
        F.concat(F.when(F.col("opens"), F.lit(before)).otherwise(""), "formatted",
                 F.when(F.col("closes"), F.lit(after)).otherwise("")).alias("formatted"),
        F.transform("mask", lambda m: F.struct((m["start"] + shift).alias("start"), (m["end"] + shift).alias("end"))).alias("mask"),
        "opens", "closes")


_TURN = re.compile(r"<<SYS>>(?P<system>.*?)<</SYS>>|\[INST\](?P<user>.*?)\[/INST\]|\[ANS\](?P<assistant>.*?)</s>"
                   r"|\[TURN\](?P<role>.*?)\[:\](?P<text>.*?)\[/TURN\]", re.S)


def turns_of(text: str, opens: bool = True) -> list[tuple[str, str]]:
    """(role, text) of each turn of a text (or of a block of one) formatted with ``TEMPLATE``."""
    out, at = [], len("<s>") if opens else 0
    while at < len(text):
        m = _TURN.match(text, at)
        if not m:
            raise ValueError(f"no turn at {at}")
        kind = m.lastgroup
        out.append((unescape(m["role"]), unescape(m["text"])) if kind in ("role", "text")
                   else (kind, unescape(m[kind])))
        at = m.end()
    return out


_DIGEST = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks come sorted by conversation and number; one block is read at a time."""
    every = under = None
    n_turns = loss_chars = chars = 0
    for batch in batches:
        out = {k: [] for k in ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for conv, text, mask, opens, closes in zip(*(batch.column(c).to_pylist() for c in (
                "conv_id", "formatted", "mask", "opens", "closes"))):
            if opens:
                every, under, n_turns, loss_chars, chars = hashlib.sha256(), hashlib.sha256(), 0, 0, 0
            for role, said in turns_of(text, opens):
                every.update(f"{role}\n{said}\n".encode())
                n_turns += 1
            for span in mask:
                said = unescape(text[span["start"]: span["end"]])
                under.update(said.encode())
                loss_chars += len(said)
            chars += len(text)
            if closes:
                for k, v in zip(out, (conv, n_turns, every.hexdigest(), loss_chars, under.hexdigest(), chars)):
                    out[k].append(v)
        yield pa.RecordBatch.from_pydict(out, pa.schema([
            ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]))


def digests(written: DataFrame) -> DataFrame:
    """What the formatted conversations hold, read back from blocks and masks alone.

    A conversation of one block is read where it is.  The blocks of others are streamed in
    order through the hashes, which no order but this one can make.
    """
    alone = F.col("opens") & F.col("closes")
    several = written.where(~alone).repartition("conv_id").sortWithinPartitions("conv_id", "block")
    return written.where(alone).mapInArrow(_digest, _DIGEST).unionByName(several.mapInArrow(_digest, _DIGEST))
