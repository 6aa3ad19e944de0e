"""Chat formatting with a small sandboxed template language.

A template is parsed into a syntax tree, constants are folded (expressions of literals and globals, branches whose
condition is known, neighbouring texts) and the rest becomes Python closures that write text and mark what stands
between ``{% generation %}`` and ``{% endgeneration %}``: the loss mask.

    {{ expr }}   {% if expr %} {% elif expr %} {% else %} {% endif %}   {% for name in messages %} {% endfor %}   {# note #}
    expr: 'text', "text", integers, true, false, names, .field, ['field'], not, and, or, ==, !=, in, ~ (joins texts), | filter, ( )

Sandbox: a name is a loop variable or a global, known when compiling; a field is a key of a message; filters come from a
fixed table; loops run over ``messages`` only and never nest. So rendering ends, and reaches no attribute of any object.

The filter ``escape`` breaks every control string in a text: a backslash goes behind its first character, and in front
of every backslash. ``unescape`` takes that back exactly.

On Spark each turn is rendered by itself (the body of the loop depends on one message), so long conversations are
spread like any other rows; the formatted conversation is its turns in order. The report reads the output back: rows
are range-sorted by conversation and turn, a partition digests the conversations that lie in it as a whole, and the
others (first and last of a partition, or above ``BLOCK`` bytes) go on as blocks that are digested in order as a
stream. Such a digest of one conversation is a chain by definition; no task holds more than a block and a turn of it.

Defined cases: null text and null role count as empty; turns are in order of turn (nulls first), then role, then the
MD5 of the text; repeated rows are turns of their own; rows without a conversation id form one conversation with a
null id; an empty table gives an empty table (the report: conversation -7 alone). Other columns are not read.
"""

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from textassay.llm.common import materialize, whole

CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "[/TURN]")
GLOBALS = {"bos": "<s>", "eos": "</s>"}
TEMPLATE = (
    "{% for message in messages %}"
    "{% if message.role == 'user' %}{{ bos ~ '[INST] ' }}{{ message.text | escape }} [/INST]"
    "{% elif message.role == 'assistant' %}{% generation %}{{ message.text | escape }}{% endgeneration %}{{ eos }}"
    "{% else %}[ROLE]{{ message.role | escape }}[/ROLE]{{ message.text | escape }}[/TURN]"
    "{% endif %}{% endfor %}"
)
BLOCK = 1 << 20


class TemplateError(ValueError):
    """The template is not of the language."""


# --- escapes -----------------------------------------------------------------------------------


def escaper(controls: Iterable[str]) -> Callable[[str], str]:
    controls = tuple(controls)
    if any(len(c) < 2 or "\\" in c for c in controls):
        raise TemplateError("control strings have two characters or more and no backslash")
    # One character at a time, so control strings that overlap are all broken.
    found = re.compile(r"(\\)|(?=%s)(.)" % "|".join(map(re.escape, controls)), re.DOTALL)
    return lambda text: found.sub(lambda m: "\\\\" if m[1] else m[2] + "\\", text)


_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text) if "\\" in text else text


# --- syntax tree -------------------------------------------------------------------------------


@dataclass
class Const:
    value: Any


@dataclass
class Name:
    name: str


@dataclass
class Call:
    """A function of other expressions: operators, field access and filters alike."""

    function: Callable
    args: list


@dataclass
class Text:
    text: str


@dataclass
class Output:
    value: Any


@dataclass
class Branch:
    arms: list  # (condition, body); the last condition of an ``else`` is Const(True)


@dataclass
class Loop:
    name: str
    body: list


@dataclass
class Generation:
    body: list


_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:('[^']*'|"[^"]*")|(\d+)|([A-Za-z_]\w*)|(==|!=|[.~|()\[\]]))""")
_WORDS = {"true": True, "false": False, "none": None}


def _field(value, key):
    if not isinstance(value, dict) or key not in value:
        raise TemplateError(f"no field {key!r}")
    return value[key]


def _shown(value) -> str:
    if isinstance(value, bool) or value is None or not isinstance(value, str | int):
        raise TemplateError(f"cannot print {value!r}")
    return str(value)


def _joined(a, b) -> str:
    return _shown(a) + _shown(b)


class _Expression:
    """Recursive descent over the tokens of one expression."""

    def __init__(self, source: str, names: set[str], filters: dict[str, Callable]):
        self.tokens, self.names, self.filters, self.source = [], names, filters, source
        at, source = 0, source.rstrip()
        while at < len(source):
            if not (m := _TOKEN.match(source, at)):
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append(next((kind, m[kind]) for kind in (1, 2, 3, 4) if m[kind] is not None))
            at = m.end()
        self.tokens.append((0, ""))

    def parse(self):
        made = self.either()
        if self.tokens[0][0]:
            raise TemplateError(f"more than an expression: {self.source!r}")
        return made

    def take(self, *wanted: str) -> str | None:
        kind, text = self.tokens[0]
        if kind in (3, 4) and text in wanted:
            self.tokens.pop(0)
            return text
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} expected in {self.source!r}")

    def word(self) -> str:
        kind, text = self.tokens.pop(0)
        if kind != 3:
            raise TemplateError(f"a name expected in {self.source!r}")
        return text

    def either(self):
        made = self.both()
        while self.take("or"):
            made = Call(lambda a, b: a or b, [made, self.both()])
        return made

    def both(self):
        made = self.negated()
        while self.take("and"):
            made = Call(lambda a, b: a and b, [made, self.negated()])
        return made

    def negated(self):
        return Call(lambda a: not a, [self.negated()]) if self.take("not") else self.compared()

    def compared(self):
        made = self.concatenated()
        while sign := self.take("==", "!=", "in"):
            other = self.concatenated()
            made = Call({"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": lambda a, b: _shown(a) in _shown(b)}[sign], [made, other])
        return made

    def concatenated(self):
        made = self.filtered()
        while self.take("~"):
            made = Call(_joined, [made, self.filtered()])
        return made

    def filtered(self):
        made = self.reached()
        while self.take("|"):
            name = self.word()
            if name not in self.filters:
                raise TemplateError(f"no filter {name!r}")
            made = Call(lambda a, use=self.filters[name]: use(_shown(a)), [made])
        return made

    def reached(self):
        made = self.atom()
        while sign := self.take(".", "["):
            if sign == ".":
                key = self.word()
            else:
                kind, text = self.tokens.pop(0)
                if kind != 1:
                    raise TemplateError(f"a quoted field expected in {self.source!r}")
                key = text[1:-1]
                self.need("]")
            made = Call(lambda a, key=key: _field(a, key), [made])
        return made

    def atom(self):
        if self.take("("):
            made = self.either()
            self.need(")")
            return made
        kind, text = self.tokens.pop(0)
        if kind == 1:
            return Const(text[1:-1])
        if kind == 2:
            return Const(int(text))
        if kind == 3 and text in _WORDS:
            return Const(_WORDS[text])
        if kind == 3 and text in self.names:
            return Name(text)
        raise TemplateError(f"unknown name or sign {text!r} in {self.source!r}")


def _parse(source: str, names: set[str], filters: dict[str, Callable]) -> list:
    """The tree of a template. Open blocks are kept on a stack: (kind, node, body that is being filled)."""
    root: list = []
    stack: list[tuple[str, Any, list]] = [("", None, root)]
    known, at = set(names), 0

    def expression(text: str):
        return _Expression(text, known, filters).parse()

    def close(kind: str) -> Any:
        if stack[-1][0] != kind:
            raise TemplateError(f"end of {kind!r} inside {stack[-1][0] or 'no block'!r}")
        return stack.pop()[1]

    for m in _TAG.finditer(source):
        stack[-1][2].append(Text(source[at : m.start()]))
        at = m.end()
        if m[1] is not None:
            stack[-1][2].append(Output(expression(m[1])))
        elif m[2] is not None:
            head, _, rest = m[2].strip().partition(" ")
            if head == "if":
                node = Branch([(expression(rest), [])])
                stack[-1][2].append(node)
                stack.append(("if", node, node.arms[-1][1]))
            elif head in ("elif", "else"):
                node = close("if")
                node.arms.append((expression(rest) if head == "elif" else Const(True), []))
                stack.append(("if", node, node.arms[-1][1]))
            elif head == "for":
                loop = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+messages", rest.strip())
                if not loop or loop[1] in known or any(kind == "for" for kind, _, _ in stack):
                    raise TemplateError(f"a loop runs over messages under a new name, and does not nest: {rest!r}")
                node = Loop(loop[1], [])
                known.add(loop[1])
                stack[-1][2].append(node)
                stack.append(("for", node, node.body))
            elif head == "generation":
                if any(kind == "generation" for kind, _, _ in stack):
                    raise TemplateError("generation blocks do not nest")
                node = Generation([])
                stack[-1][2].append(node)
                stack.append(("generation", node, node.body))
            elif head in ("endif", "endfor", "endgeneration"):
                node = close(head[3:])
                if isinstance(node, Loop):
                    known.discard(node.name)
            else:
                raise TemplateError(f"unknown tag {head!r}")
    root_open = stack[-1]
    root_open[2].append(Text(source[at:]))
    if len(stack) > 1:
        raise TemplateError(f"{root_open[0]!r} is not closed")
    return root


# --- constants ---------------------------------------------------------------------------------


def _folded(node, values: dict[str, Any]):
    if isinstance(node, Name):
        return Const(values[node.name]) if node.name in values else node
    if isinstance(node, Call):
        args = [_folded(a, values) for a in node.args]
        return Const(node.function(*[a.value for a in args])) if all(isinstance(a, Const) for a in args) else Call(node.function, args)
    return node


def _fold(body: list, values: dict[str, Any]) -> list:
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].text + node.text)
        elif not isinstance(node, Text) or node.text:
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            value = _folded(node.value, values)
            add(Text(_shown(value.value)) if isinstance(value, Const) else Output(value))
        elif isinstance(node, Branch):
            arms = []
            for condition, inner in node.arms:
                condition = _folded(condition, values)
                if isinstance(condition, Const) and not condition.value:
                    continue
                arms.append((condition, _fold(inner, values)))
                if isinstance(condition, Const):
                    break
            if arms and isinstance(arms[0][0], Const):
                for inner in arms[0][1]:
                    add(inner)
            elif arms:
                add(Branch(arms))
        elif isinstance(node, Loop | Generation):
            inner = _fold(node.body, values)
            add(Loop(node.name, inner) if isinstance(node, Loop) else Generation(inner))
        else:
            add(node)
    return out


# --- closures ----------------------------------------------------------------------------------


@dataclass
class Written:
    """What a rendering writes: pieces, code points so far, and the marked spans."""

    pieces: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)

    @property
    def text(self) -> str:
        return "".join(self.pieces)


def _value(node) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda names, value=node.value: value
    if isinstance(node, Name):
        return lambda names, name=node.name: names[name]
    parts, function = [_value(a) for a in node.args], node.function
    if len(parts) == 1:
        only = parts[0]
        return lambda names: function(only(names))
    first, second = parts
    return lambda names: function(first(names), second(names))


def _writer(body: list) -> Callable[[dict, Written], None]:
    steps = [_step(node) for node in body]

    def write(names: dict, out: Written) -> None:
        for step in steps:
            step(names, out)

    return steps[0] if len(steps) == 1 else write


def _step(node) -> Callable[[dict, Written], None]:
    if isinstance(node, Text):
        return lambda names, out, text=node.text: out.put(text)
    if isinstance(node, Output):
        value = _value(node.value)
        return lambda names, out: out.put(_shown(value(names)))
    if isinstance(node, Branch):
        arms = [(_value(condition), _writer(inner)) for condition, inner in node.arms]

        def choose(names: dict, out: Written) -> None:
            for condition, inner in arms:
                if condition(names):
                    return inner(names, out)

        return choose
    inner = _writer(node.body)
    if isinstance(node, Generation):

        def marked(names: dict, out: Written) -> None:
            start = out.size
            inner(names, out)
            out.spans.append((start, out.size))

        return marked

    def repeat(names: dict, out: Written) -> None:
        for message in names["messages"]:
            inner(names | {node.name: message}, out)

    return repeat


class Template:
    """A compiled template: ``tree`` is the folded syntax tree."""

    def __init__(self, source: str = TEMPLATE, values: dict[str, Any] | None = None, controls: Iterable[str] = CONTROLS):
        values = dict(GLOBALS if values is None else values)
        filters = {"escape": escaper(controls), "trim": str.strip, "upper": str.upper, "lower": str.lower}
        self.tree = _fold(_parse(source, set(values), filters), values)
        self._write = _writer(self.tree)

    def render(self, messages: Iterable[dict]) -> Written:
        """A whole conversation in memory."""
        out = Written()
        self._write({"messages": messages}, out)
        return out

    def turn(self) -> Callable[[dict], Written]:
        """Renders one message; only for templates that are one loop over the messages and nothing else."""
        if len(self.tree) != 1 or not isinstance(self.tree[0], Loop):
            raise TemplateError("turns can be rendered apart only where all of the template is in one loop over messages")
        return lambda message: self.render((message,))


# --- on Spark ----------------------------------------------------------------------------------


def format_turns(df: DataFrame, source: str = TEMPLATE, values: dict[str, Any] | None = None, controls: Iterable[str] = CONTROLS) -> DataFrame:
    """(conv_id, turn, formatted, loss): every turn as the template writes it, a narrow step that keeps the order of rows.

    ``loss`` holds the marked spans (start, end: code points of ``formatted``). A conversation is its turns in order.
    """
    Template(source, values, controls).turn()  # a faulty template fails here, not in the tasks

    @pandas_udf("formatted string, starts array<int>, ends array<int>")
    def rendered(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        render = Template(source, values, controls).turn()
        for roles, texts in batches:
            done = [render({"role": r, "text": t}) for r, t in zip(roles, texts, strict=True)]
            yield pd.DataFrame({
                "formatted": [d.text for d in done], "starts": [[a for a, _ in d.spans] for d in done], "ends": [[b for _, b in d.spans] for d in done],
            })

    made = df.select("conv_id", "turn", rendered(whole("role"), whole("text")).alias("_made"))
    loss = F.arrays_zip(F.col("_made.starts").alias("start"), F.col("_made.ends").alias("end"))
    return made.select("conv_id", "turn", F.col("_made.formatted").alias("formatted"), loss.alias("loss"))


def read_turn(text: str, at: int = 0) -> tuple[str, str, int] | None:
    """(role, text, end) of the turn that begins at ``at`` in the output of TEMPLATE; None if it does not end there."""

    def until(mark: str, start: int) -> int:
        return text.find(mark, start)

    if text.startswith("<s>[INST] ", at):
        end = until(" [/INST]", at + 10)
        return None if end < 0 else ("user", unescape(text[at + 10 : end]), end + 8)
    if text.startswith("[ROLE]", at):
        mid = until("[/ROLE]", at + 6)
        end = until("[/TURN]", mid + 7) if mid >= 0 else -1
        return None if end < 0 else (unescape(text[at + 6 : mid]), unescape(text[mid + 7 : end]), end + 7)
    end = until("</s>", at)
    return None if end < 0 else ("assistant", unescape(text[at:end]), end + 4)


_COUNTS = "n_turns bigint, loss_chars bigint, formatted_chars bigint"


class _Reading:
    """One conversation, or a part of it, being read back."""

    def __init__(self, conv_id):
        self.conv_id, self.rest = conv_id, ""
        self.turns, self.loss = bytearray(), bytearray()
        self.counts = [0, 0, 0]

    def read(self, formatted: str, loss: list[dict]) -> None:
        for span in loss:
            text = unescape(formatted[span["start"] : span["end"]])
            self.loss += text.encode()
            self.counts[1] += len(text)
        self.counts[2] += len(formatted)
        self.rest += formatted
        at = 0
        while at < len(self.rest) and (found := read_turn(self.rest, at)):
            role, text, at = found
            self.turns += f"{role}\n{text}\n".encode()
            self.counts[0] += 1
        self.rest = self.rest[at:]

    def checked(self) -> "_Reading":
        if self.rest:
            raise ValueError(f"the output of conversation {self.conv_id} cannot be read back")
        return self


def _segments_schema(id_type: str) -> str:
    return f"conv_id {id_type}, segment bigint, block bigint, {_COUNTS}, turns binary, loss binary, turns_sha256 string, loss_sha256 string"


def _read_segments(id_type: pa.DataType):
    """Digests of conversations that lie in one partition as a whole, blocks of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, now, first, block, rows = TaskContext.get().partitionId(), None, True, 0, []

        def as_block(part: _Reading) -> list:
            return [part.conv_id, segment, block, *part.counts, bytes(part.turns), bytes(part.loss), None, None]

        def as_digests(part: _Reading) -> list:
            return [part.conv_id, segment, None, *part.counts, None, None, hashlib.sha256(part.turns).hexdigest(), hashlib.sha256(part.loss).hexdigest()]

        def batch_of(rows: list[list]) -> pa.RecordBatch:
            kinds = [id_type, *[pa.int64()] * 5, pa.binary(), pa.binary(), pa.string(), pa.string()]
            names = ["conv_id", "segment", "block", "n_turns", "loss_chars", "formatted_chars", "turns", "loss", "turns_sha256", "loss_sha256"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for conv_id, formatted, loss in zip(*columns, strict=True):
                if now is None or conv_id != now.conv_id:
                    if now is not None:
                        rows.append(as_block(now.checked()) if first or block else as_digests(now.checked()))
                        first = False
                    now, block = _Reading(conv_id), 0
                now.read(formatted, loss)
                if len(now.turns) >= BLOCK:
                    rows.append(as_block(now.checked()))
                    yield batch_of(rows)
                    now, block, rows = _Reading(conv_id), block + 1, []
                elif len(rows) >= 1000:
                    yield batch_of(rows)
                    rows = []
        if now is not None:
            rows.append(as_block(now.checked()))  # it may go on in the next partition
            yield batch_of(rows)

    return run


def _join_blocks(id_type: pa.DataType):
    """Digests of conversations whose blocks come in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, started = None, False

        def row() -> pa.RecordBatch:
            conv_id, counts, turns, loss = now
            values = [conv_id, *counts, turns.hexdigest(), loss.hexdigest()]
            kinds = [id_type, *[pa.int64()] * 3, pa.string(), pa.string()]
            names = ["conv_id", "n_turns", "loss_chars", "formatted_chars", "turns_sha256", "loss_sha256"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], names)

        for batch in batches:
            for r in batch.to_pylist():
                if not started or r["conv_id"] != now[0]:
                    if started:
                        yield row()
                    now, started = (r["conv_id"], [0, 0, 0], hashlib.sha256(), hashlib.sha256()), True
                now[2].update(r["turns"])
                now[3].update(r["loss"])
                for i, name in enumerate(("n_turns", "loss_chars", "formatted_chars")):
                    now[1][i] += r[name]
        if started:
            yield row()

    return run


def read_back(ordered: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) of formatted turns in ``range order``.

    ``ordered`` is the output of ``format_turns`` with TEMPLATE over rows that are range-sorted by conversation and
    turn. Runs that step when called.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = ordered.schema["conv_id"].dataType
    id_type, name = to_arrow_type(kind), kind.simpleString()
    read = ordered.select("conv_id", "formatted", "loss").mapInArrow(_read_segments(id_type), _segments_schema(name))
    segments = materialize(read, "chat-segments")
    result = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    blocks = segments.where("block is not null").select("conv_id", "segment", "block", "n_turns", "loss_chars", "formatted_chars", "turns", "loss")
    in_order = blocks.repartition("conv_id").sortWithinPartitions("conv_id", "segment", "block")
    joined = in_order.mapInArrow(_join_blocks(id_type), f"conv_id {name}, {_COUNTS}, turns_sha256 string, loss_sha256 string")
    return segments.where("block is null").select(*result).unionByName(joined.select(*result))


def in_turn_order(df: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) range-sorted; a conversation of any length spreads over as many partitions as it fills."""
    rows = df.select("conv_id", "turn", whole("role").alias("role"), whole("text").alias("text"))
    rows = rows.withColumns({"_text": F.md5("text"), "_row": F.monotonically_increasing_id()})  # equal rows spread as well
    keys = ["conv_id", "turn", "role", "_text", "_row"]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def formatting_report(conversations: DataFrame) -> DataFrame:
    """The digests of all conversations, and of conversation -7 whose texts are made of control strings."""
    spark, saying = conversations.sparkSession, "</s>[INST] ok [/INST]"
    own = conversations.select("conv_id", "turn", "role", "text")
    kinds = {n: own.schema[n].dataType for n in ("conv_id", "turn")}
    extra = spark.range(2).select(
        F.lit(-7).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(saying).alias("text"),
    )
    return read_back(format_turns(in_turn_order(own.unionByName(extra))))
