"""Small payload schemas of our own, and the record envelopes used by sources and plans."""

from __future__ import annotations

from quillforge.schema.kinds import (
    AnyObject,
    Boolean,
    Choice,
    Field,
    Integer,
    Items,
    Number,
    PayloadSchema,
    Record,
    Text,
)
from quillforge.schema.registry import register_schema

ROLES = ("system", "user", "assistant")

# --- envelopes -------------------------------------------------------------

DOCUMENT = Record(Field("content", Text()), Field("source", Text()), Field("timestamp", Text()))

TRAINING_EXAMPLE = Record(Field("content", Text()), Field("output", AnyObject()))

CHAT_MESSAGE = Record(
    Field("role", Choice(*ROLES)),
    Field("content", Text()),
    Field("name", Text(), nullable=True, default=None),
)

CHAT_SAMPLE = Record(Field("messages", Items(CHAT_MESSAGE)))

_TEXT_PART = Record(Field("type", Choice("text")), Field("text", Text()))

BATCH_REPLY = Record(
    Field(
        "modelInput",
        Record(
            Field("anthropic_version", Text()),
            Field("max_tokens", Integer()),
            Field(
                "messages",
                Items(Record(Field("role", Choice("user", "assistant")), Field("content", Items(_TEXT_PART)))),
            ),
        ),
    ),
    Field(
        "modelOutput",
        Record(
            Field("model", Text()),
            Field("id", Text()),
            Field("type", Text()),
            Field("role", Text()),
            Field("content", Items(_TEXT_PART)),
            Field("stop_reason", Text()),
            Field("stop_sequence", Text(), nullable=True, default=None),
            Field("usage", AnyObject()),
        ),
    ),
    Field("recordId", Text()),
)

# --- payload schemas -------------------------------------------------------

ONE_FIELD = register_schema(
    PayloadSchema("one_field", "1.0.0", Record(Field("field", Text())), example={"field": "a"})
)

TWO_FIELD = register_schema(
    PayloadSchema(
        "two_field", "1.0.0", Record(Field("foo", Text()), Field("bar", Integer())), example={"foo": "a", "bar": 1}
    )
)

EVENT = register_schema(
    PayloadSchema(
        "event_payload",
        "1.2.0",
        Record(
            Field("event_id", Integer()),
            Field("event_type", Choice("click", "view", "purchase", "signup", "error")),
            Field("value", Number(ge=0)),
            Field("k", Integer(ge=0, le=99)),
        ),
        generation_template="Describe the event as JSON.\n{SCHEMA}\nFor example:\n{EXAMPLE}\n",
        main_template="Describe the event as JSON.\n{SCHEMA}\n",
        example={"event_id": 1, "event_type": "view", "value": 1.5, "k": 7},
    )
)

ENTITY = register_schema(
    PayloadSchema(
        "entity_payload",
        "0.3.1",
        Record(
            Field("is_relevant", Boolean(), description="gate: false means nothing else is looked for"),
            Field(
                "entities",
                Items(
                    Record(
                        Field("entity", Choice("person", "place", "thing", "other")),
                        Field("source_text", Text()),
                        Field("assertion", Choice("positive", "negated", "unclear")),
                        Field("snippets", Items(Text(), max_length=4), default=[]),
                        Field("year", Integer(ge=1900, le=2100), nullable=True, default=None),
                    )
                ),
                nullable=True,
            ),
        ),
        generation_template="List the entities of the text.\n{SCHEMA}\nFor example:\n{EXAMPLE}\n",
        main_template="List the entities of the text.\n{SCHEMA}\n",
        example={
            "is_relevant": True,
            "entities": [{"entity": "person", "source_text": "Ann", "assertion": "positive", "year": 2001}],
        },
    )
)

REPORT = register_schema(
    PayloadSchema(
        "report_payload",
        "2.0.0",
        Record(
            Field("status", Choice("draft", "final")),
            Field(
                "finding",
                Record(
                    Field("grade", Choice("low", "high")),
                    Field("size", Number(ge=0), nullable=True),
                    fold_choices=True,
                ),
                nullable=True,
            ),
            Field("notes", Items(Text()), default=[]),
            Field("flag", Boolean(), default=False),
            fold_choices=True,
        ),
        example={"status": "final", "finding": None, "notes": []},
    )
)
