"""Chat formatting: records of many layouts become turns, and turns one marked text.

A record is JSON. The paths of its nested fields, without values and scalar types, are hashed;
the hash selects a declarative mapping that reads the record's turns. A template then marks the
turns and escapes its control strings inside texts, so that the result can be read back exactly.
Only DataFrame functions run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabmill.llm.common import chosen, read

TURNS = "array<struct<role:string,text:string>>"
#: Fixed values: `try_parse_json` gives null for a string above 20 million characters and a record
#: above 128 MB; records from this length on are never taken for broken JSON.
PARSER_CHARS = 20_000_000
#: A role up to this length stands in the record itself; a longer one is a reference.
ROLE_CHARS, REFERENCE = 64, "\x01"


@dataclass(frozen=True)
class Mapping:
    """How a layout's fields become turns.

    ``shapes`` are the field paths it is chosen for, as ``shape_of`` writes them. Either ``each``
    names an array (a path, its role field, its text field), or ``parts`` lists (role, path) in
    order; a part whose field is absent or null makes no turn unless it is in ``kept``.
    """

    name: str
    shapes: tuple[str, ...]
    each: tuple[str, str, str] | None = None
    parts: tuple[tuple[str, str], ...] = ()
    roles: dict[str, str] = field(default_factory=dict, hash=False)


# The public layouts that are understood.
MAPPINGS = (
    Mapping("messages", ("OBJECT<messages: ARRAY<OBJECT<content, role>>>",), ("$.messages", "role", "content")),
    Mapping("message_list", ("ARRAY<OBJECT<content, role>>",), ("$", "role", "content")),
    Mapping(
        "from_value", ("OBJECT<conversations: ARRAY<OBJECT<from, value>>>",), ("$.conversations", "from", "value"),
        roles={"human": "user", "gpt": "assistant"},
    ),
    Mapping(
        "prompt", ("OBJECT<completion, prompt>",), parts=(("user", "$.prompt"), ("assistant", "$.completion"))
    ),
    Mapping(
        "response", ("OBJECT<prompt, response>",), parts=(("user", "$.prompt"), ("assistant", "$.response"))
    ),
    Mapping(
        "question", ("OBJECT<answer, question>",), parts=(("user", "$.question"), ("assistant", "$.answer"))
    ),
    Mapping(
        "instruction",
        ("OBJECT<instruction, output>", "OBJECT<instruction, output, system>"),
        parts=(("system", "$.system"), ("user", "$.instruction"), ("assistant", "$.output")),
    ),
    Mapping(
        "instruction_input",
        ("OBJECT<input, instruction, output>",),
        parts=(("user", "$.instruction"), ("user", "$.input"), ("assistant", "$.output")),
    ),
)

_SCALAR = r": (?:STRING|VOID|BIGINT|DOUBLE|FLOAT|BOOLEAN|DATE|TIMESTAMP|TIMESTAMP_NTZ|BINARY|VARIANT|DECIMAL\(\d+,\d+\))(?=[,>])"


def shape_of(record: Column) -> Column:
    """Nested field paths of a variant: names by alphabet, arrays marked, scalar types left out."""
    return F.regexp_replace(F.schema_of_variant(record), _SCALAR, "")


def _turns(record: Column, m: Mapping) -> Column:
    if m.each:
        path, role, text = m.each
        rows = F.try_variant_get(record, path, f"array<struct<`{role}`:string,`{text}`:string>>")
        named = lambda c: F.coalesce(
            *(F.when(c == old, F.lit(new)) for old, new in m.roles.items()), c, F.lit("")
        )
        return F.transform(
            rows, lambda x: F.struct(named(x[role]).alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))
        )
    parts = F.array(*(
        F.struct(F.lit(role).alias("role"), F.try_variant_get(record, path, "string").alias("text"))
        for role, path in m.parts
    ))
    return F.filter(parts, lambda x: x["text"].isNotNull())


def canonical_turns(records: DataFrame, mappings: tuple[Mapping, ...] = MAPPINGS) -> DataFrame:
    """Adds fingerprint, layout and turns to records with a JSON column ``record``.

    A record that is no JSON, or of no known shape, keeps its row with a null layout and null
    turns, so the unknown fingerprints can be counted and given a mapping. A record that may be
    beyond the parser's limits raises an error.
    """
    value = F.try_parse_json("record")
    parsed = records.withColumn("_v", F.when(F.length("record") < PARSER_CHARS, value).otherwise(
        F.coalesce(value, F.when(F.col("record").isNotNull(), F.raise_error(
            F.concat(F.lit("a record is no JSON or beyond the parser's limits; its characters: "), F.length("record"))
        ).cast("variant")))
    ))
    printed = parsed.withColumn("fingerprint", F.xxhash64(shape_of(F.col("_v"))))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        hit = F.col("fingerprint").isin([F.xxhash64(F.lit(s)) for s in m.shapes])
        layout = F.when(hit, F.lit(m.name)).otherwise(layout)
        turns = F.when(hit, _turns(F.col("_v"), m).cast(TURNS)).otherwise(turns)
    return printed.withColumns({"layout": layout, "turns": turns}).drop("_v")


@dataclass(frozen=True)
class Template:
    """Marks around a turn. ``controls`` is a pattern of what follows the first character of any
    control string (of this template and of others in use); such a character gets a backslash
    behind it, and a backslash is doubled."""

    open: str = "<|im_start|>"
    middle: str = "<|im_sep|>"
    close: str = "<|im_end|>"
    controls: str = r"([<\[])(?=\||/?s>|/?INST\]|</?SYS>>)"
    loss_roles: tuple[str, ...] = ("assistant",)

    def escape(self, text: Column) -> Column:
        doubled = F.regexp_replace(text, r"\\", r"\\\\")
        return F.regexp_replace(doubled, self.controls, r"$1\\")

    @staticmethod
    def unescape(text: Column) -> Column:
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def segments(self, turns: Column) -> Column:
        """array<struct<text,loss>>: the formatted text in pieces, with the loss mask."""
        piece = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.flatten(F.transform(turns, lambda t: F.array(
            piece(F.concat(F.lit(self.open), self.escape(t["role"]), F.lit(self.middle)), F.lit(False)),
            piece(self.escape(t["text"]), t["role"].isin(*self.loss_roles)),
            piece(F.lit(self.close), F.lit(False)),
        )))

    def parse(self, formatted: Column) -> Column:
        """The turns of a formatted text."""
        quoted = lambda mark: r"\Q" + mark + r"\E"
        blocks = F.filter(F.split(formatted, quoted(self.close), -1), lambda b: b != "")
        return F.transform(blocks, lambda b: F.struct(
            self.unescape(F.substring_index(F.substring(b, len(self.open) + 1, 2**31 - 1), self.middle, 1)).alias("role"),
            self.unescape(F.substring_index(b, self.middle, -1)).alias("text"),
        ))


def format_chats(records: DataFrame, template: Template | None = None) -> DataFrame:
    """Adds layout, turns, segments (text, loss) and formatted, the segments' texts in a row."""
    return formatted_turns(canonical_turns(records), template or Template())


def formatted_turns(turned: DataFrame, t: Template) -> DataFrame:
    turned = turned.withColumn("segments", t.segments(F.col("turns")))
    return turned.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def records_of(rows: DataFrame) -> DataFrame:
    """(conv_id, record, said) of rows (conv_id, turn, role, text), ordered by turn, then role and
    text. ``said`` has the roles and texts; in the record, places in it stand for texts and long
    roles, so none of them meets the limits of the JSON parser.

    Short conversations take the layout of their kind, all others that of messages."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    grouped = rows.groupBy("conv_id").agg(turns.alias("said"))
    roles = F.transform("said", lambda x: x["role"])
    is_pair = roles == F.array(F.lit("user"), F.lit("assistant"))
    is_task = roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant"))
    text = lambda i: F.lit(str(i))
    long = lambda role: (F.length(role) > ROLE_CHARS) | role.startswith(REFERENCE)
    messages = F.transform("said", lambda x, i: F.struct(
        F.when(long(x["role"]), F.concat(F.lit(REFERENCE), i.cast("string"))).otherwise(x["role"]).alias("role"),
        i.cast("string").alias("content"),
    ))
    return grouped.select(
        "conv_id",
        F.when(is_pair, F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(
            is_task,
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages")))).alias("record"),
        "said",
    )


def resolved(turns: Column, said: Column) -> Column:
    """Turns with the roles and texts that their references stand for."""
    at = lambda reference: F.get(said, reference.cast("int"))
    return F.transform(turns, lambda t: F.struct(
        F.when(t["role"].startswith(REFERENCE), at(F.substring(t["role"], 2, 10))["role"]).otherwise(t["role"]).alias("role"),
        at(t["text"])["text"].alias("text"),
    ))


def conversation_digests(rows: DataFrame) -> DataFrame:
    """Per conversation the digests of what its formatted text and loss mask read back as.

    Null roles and texts are empty; repeated rows are turns of their own; rows without a conv_id
    form one conversation with a null id; an empty table gives no rows; further columns are
    ignored. A conversation is one text, so its rows meet in one task; copies of a conversation
    have ids, and tasks, of their own.
    """
    t = Template()
    rows = chosen(rows, conv_id="long", turn="long", role="string", text="string")
    rows = rows.withColumns({c: F.coalesce(c, F.lit("")) for c in ("role", "text")})
    turned = canonical_turns(records_of(rows))
    unread = F.raise_error(F.concat(F.lit("conversation can't be read: "), F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))))
    turned = turned.withColumn("turns", F.coalesce(resolved(F.col("turns"), F.col("said")), unread.cast(TURNS)))
    out = formatted_turns(turned, t).select("conv_id", "formatted", "segments", t.parse(F.col("formatted")).alias("turns"))
    told = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = t.unescape(F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: s["text"]), ""))
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one more, numbered -7, whose texts are control strings."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "'</s>[INST] ok [/INST]'"
    more = spark.range(2).selectExpr(
        "-7L AS conv_id", "id AS turn", "IF(id = 0, 'user', 'assistant') AS role", f"{hard} AS text"
    )
    return conversation_digests(rows.unionByName(more))
