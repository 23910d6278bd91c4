"""Chat formatting: rows of any known layout to canonical turns, and turns to
one marked string with a loss mask.

A table of mixed sources (as ``spark.read.json`` gives) has the fields of all
layouts, null where a row's source lacks them. Per row the nested field paths
that are present are hashed; the hash selects a declarative ``Layout`` from
the catalogue, all in one projection of built-in expressions. Fields that no
layout names take no part. A row whose paths fit no layout keeps its
fingerprint and gets null turns, so it can be counted and never vanishes.

The template marks where a turn starts, where its role ends and where it
ends. Control strings inside roles and texts are broken up by a backslash
after their first character, one more for every backslash that stands there
already; taking one out again restores any text. The output is an array of
segments with a loss label; their concatenation is the formatted string.

Defined cases: a null text is empty, a null role is the empty role. A turn of
a field layout whose fields are all null is left out. An empty list of
messages has no turns and an empty string. Turn rows with equal numbers are
ordered by role and text; repeated rows are turns of their own; null ids are
one conversation. Empty tables stay empty. Columns with the names of outputs
are replaced. A conversation is one row, and so must fit into one.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

TURNS = "array<struct<role: string, text: string>>"
LOSS_ROLES = ("assistant",)


@dataclass(frozen=True)
class Turn:
    """A turn of a layout of fields: the texts at ``paths``, joined."""

    role: str
    paths: tuple[str, ...]
    joint: str = "\n\n"


@dataclass(frozen=True)
class Layout:
    """``turns`` for rows with a field per turn, or ``items`` for rows with a
    list of messages, ``role`` and ``text`` naming fields of an item (or of the
    row itself, if ``items`` is empty). ``roles`` renames roles."""

    name: str
    turns: tuple[Turn, ...] = ()
    items: str = ""
    role: str = ""
    text: str = ""
    roles: dict[str, str] = field(default_factory=dict)
    optional: tuple[str, ...] = ()

    def paths(self) -> list[str]:
        if self.turns:
            return [p for t in self.turns for p in t.paths]
        at = f"{self.items}[]" if self.items else ""
        return [at] * bool(at) + [f"{at}.{x}" if at else x for x in (self.role, self.text)]

    def shapes(self) -> list[str]:
        """The sorted paths of every row that this layout describes."""
        must = [p for p in self.paths() if p not in self.optional]
        return ["\n".join(sorted([*must, *some])) for n in range(len(self.optional) + 1)
                for some in itertools.combinations(self.optional, n)]


#: The catalogue. No two layouts may describe the same set of paths.
LAYOUTS = (
    Layout("prompt-response", (Turn("user", ("prompt",)), Turn("assistant", ("response",))), optional=("response",)),
    Layout("prompt-completion", (Turn("user", ("prompt",)), Turn("assistant", ("completion",)))),
    Layout("instruction", (Turn("user", ("instruction", "input")), Turn("assistant", ("output",))), optional=("input", "output")),
    Layout("question-answer", (Turn("user", ("question",)), Turn("assistant", ("answer",)))),
    Layout("system-question", (Turn("system", ("system_prompt",)), Turn("user", ("question",)), Turn("assistant", ("response",))),
           optional=("system_prompt",)),
    Layout("messages", items="messages", role="role", text="content", optional=("messages[].role", "messages[].content")),
    Layout("conversations", items="conversations", role="from", text="value", roles={"human": "user", "gpt": "assistant"},
           optional=("conversations[].from", "conversations[].value")),
    Layout("turn", role="role", text="text", optional=("text", "role")),
)


def schema_paths(schema: StructType, prefix: str = "") -> list[str]:
    """Nested field paths of a schema: ``a.b`` for fields of structs, ``a[]``
    for a list and ``a[].b`` for fields of its structs."""
    out = []
    for f in schema.fields:
        if not f.name or any(c in f.name for c in ".[]`"):
            continue
        at = prefix + f.name
        kind = f.dataType
        if isinstance(kind, ArrayType):
            out.append(f"{at}[]")
            if isinstance(kind.elementType, StructType):
                out += [f"{at}[].{x.name}" for x in kind.elementType.fields if not isinstance(x.dataType, (StructType, ArrayType, MapType))]
        elif isinstance(kind, StructType):
            out += schema_paths(kind, f"{at}.")
        elif not isinstance(kind, MapType):
            out.append(at)
    return out


def _col(path: str) -> Column:
    return F.col(".".join(f"`{x}`" for x in path.split(".")))


def _present(path: str) -> Column:
    at, is_list, inner = path.partition("[]")
    if is_list and inner:
        return F.coalesce(F.exists(_col(at), lambda x: x[inner[1:]].isNotNull()), F.lit(False))
    return _col(at).isNotNull()


def _known(df: DataFrame, layouts: tuple[Layout, ...]) -> list[str]:
    named = {p for x in layouts for p in x.paths()}
    return sorted(named & set(schema_paths(df.schema)))


def fingerprint(df: DataFrame, layouts: tuple[Layout, ...] = LAYOUTS) -> Column:
    """Hash of the paths that a row has and some layout names."""
    some = [F.when(_present(p), F.lit(p)) for p in _known(df, layouts)]
    return F.xxhash64(F.concat_ws("\n", *some))


def _turns(layout: Layout, known: set[str]) -> Column:
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))

    def role(c: Column) -> Column:
        names = F.create_map(*[F.lit(x) for kv in layout.roles.items() for x in kv]) if layout.roles else None
        return text(c) if names is None else F.coalesce(F.element_at(names, text(c)), text(c))

    def at(path: str) -> Column:
        return _col(path) if path in known else F.lit(None).cast("string")

    def struct(r: Column, t: Column) -> Column:
        return F.struct(r.alias("role"), t.alias("text"))

    if layout.turns:
        every = []
        for t in layout.turns:
            some = F.coalesce(*[at(p).cast("string") for p in t.paths]).isNotNull()
            every.append(F.when(some, struct(F.lit(t.role), F.concat_ws(t.joint, *[at(p).cast("string") for p in t.paths]))))
        return F.array_compact(F.array(*every))
    if not layout.items:
        return F.array(struct(role(at(layout.role)), text(at(layout.text))))
    inner = lambda x, name: x[name] if f"{layout.items}[].{name}" in known else F.lit(None).cast("string")
    return F.transform(_col(layout.items), lambda x: struct(role(inner(x, layout.role)), text(inner(x, layout.text))))


def canonical(df: DataFrame, keep: list[str], layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """The columns ``keep`` with ``fingerprint``, ``layout`` and ``turns``."""
    known = set(_known(df, layouts))
    print_ = F.col("fingerprint")
    layout, turns, seen = F.lit(None).cast("string"), F.lit(None).cast(TURNS), {}
    for x in layouts:
        shapes = [s for s in x.shapes() if s]
        for s in shapes:
            if s in seen:
                raise ValueError(f"layouts {seen[s]} and {x.name} describe the same paths: {s.split()}")
            seen[s] = x.name
        if any(set(s.split("\n")) <= known for s in shapes):
            layout = F.when(print_.isin([F.xxhash64(F.lit(s)) for s in shapes]), F.lit(x.name)).otherwise(layout)
            turns = F.when(F.col("layout") == x.name, _turns(x, known).cast(TURNS)).otherwise(turns)
    out = df.withColumn("fingerprint", fingerprint(df, layouts)).withColumn("layout", layout).withColumn("turns", turns)
    return out.select(*keep, "fingerprint", "layout", "turns")


@dataclass(frozen=True)
class Template:
    """Marks around turns, and the strings that texts must not hold: each an
    ``opener`` and one of the ``rests`` (patterns) that follow it."""

    start: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    end: str = "<|im_end|>\n"
    # Control strings of public chat templates.
    controls: tuple[tuple[str, str], ...] = (
        ("<", r"\|(?:im_start|im_sep|im_end|endoftext)\|>|/?s>|</?SYS>>"),
        (r"\[", r"/?INST\]"),
    )

    def escape(self, c: Column) -> Column:
        for opener, rests in self.controls:
            c = F.regexp_replace(c, rf"({opener})(\\*)({rests})", r"$1\\$2$3")
        return c

    def unescape(self, c: Column) -> Column:
        for opener, rests in self.controls:
            c = F.regexp_replace(c, rf"({opener})\\(\\*)({rests})", "$1$2$3")
        return c


TEMPLATE = Template()


def formatted(df: DataFrame, template: Template = TEMPLATE, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """``df`` with ``segments`` (loss, text) of its ``turns``, and ``formatted``,
    their concatenation. The loss is on the texts of ``loss_roles``."""

    def pieces(t: Column) -> Column:
        piece = lambda loss, text: F.struct(loss.alias("loss"), text.alias("text"))
        no = F.lit(False)
        head = F.concat(F.lit(template.start), template.escape(t["role"]), F.lit(template.middle))
        return F.array(piece(no, head), piece(t["role"].isin(*loss_roles), template.escape(t["text"])), piece(no, F.lit(template.end)))

    out = df.withColumn("segments", F.flatten(F.transform("turns", pieces)))
    return out.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_back(df: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """``df`` with ``turns`` parsed from ``formatted``, and ``loss_text``, the
    texts under the loss labels of ``segments``, unescaped, in order."""
    quoted = lambda s: "".join(f"\\{c}" if c in r"\.[]{}()*+-?^$|<>" else c for c in s)

    def turn(x: Column) -> Column:
        at = F.instr(x, template.middle)
        role = F.substring(x, F.lit(len(template.start) + 1), at - len(template.start) - 1)
        text = F.substring(x, at + len(template.middle), F.length(x))
        return F.struct(template.unescape(role).alias("role"), template.unescape(text).alias("text"))

    marked = F.split("formatted", quoted(template.end))
    loss = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return (df.withColumn("turns", F.transform(F.slice(marked, 1, F.greatest(F.size(marked) - 1, F.lit(0))), turn))
            .withColumn("loss_text", F.array_join(loss, "")))


def conversations(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn") -> DataFrame:
    """(conv_id, turns): the turns of each conversation, in order, of rows
    that hold a turn each in a layout of one turn a row."""
    one = canonical(rows, [conv_id, turn])
    item = F.struct(F.col(turn).alias("no"), F.col("turns")[0]["role"].alias("role"), F.col("turns")[0]["text"].alias("text"))
    turns = F.transform(F.sort_array(F.collect_list(item)), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    return one.groupBy(F.col(conv_id).alias("conv_id")).agg(turns.alias("turns"))


def as_sources(convs: DataFrame) -> DataFrame:
    """(conv_id, turns) as a table of mixed sources, each row in the layout
    that its roles allow: a prompt and response, a system prompt with a
    question and response, a list in the ``from`` / ``value`` form if it opens
    with the system's turn, or else a list of messages."""
    t = F.col("turns")
    roles = F.concat_ws(",", t["role"])
    renamed = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")])
    kind = (F.when(roles == "user,assistant", "pair").when(roles == "system,user,assistant", "triple")
            .when(roles.rlike(r"^system(,(user|assistant|system))*\z") & (F.size(t) > 1), "from").otherwise("list"))
    own = lambda name, value: F.when(F.col("kind") == name, value)
    text = lambda i: F.get(t, F.lit(i))["text"]
    return convs.withColumn("kind", kind).select(
        "conv_id",
        own("pair", text(0)).alias("prompt"),
        own("triple", text(0)).alias("system_prompt"),
        own("triple", text(1)).alias("question"),
        F.when(F.col("kind") == "pair", text(1)).when(F.col("kind") == "triple", text(2)).alias("response"),
        own("from", F.transform(t, lambda x: F.struct(renamed[x["role"]].alias("from"), x["text"].alias("value")))).alias("conversations"),
        own("list", F.transform(t, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("messages"))


def digests(df: DataFrame) -> DataFrame:
    """(conv_id, layout, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars) of rows of ``read_back``."""
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    count = lambda c: c.cast("long")
    return df.select("conv_id", count(F.size("turns")).alias("n_turns"), F.sha2(F.array_join(said, "").cast("binary"), 256).alias("turns_sha256"),
                     count(F.length("loss_text")).alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
                     count(F.length("formatted")).alias("formatted_chars"), "layout")
