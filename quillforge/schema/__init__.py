from quillforge.schema.kinds import (
    REQUIRED,
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
from quillforge.schema.registry import get_schema, register_schema, self_check

__all__ = [
    "REQUIRED", "AnyObject", "Boolean", "Choice", "Field", "Integer", "Items", "Number",
    "PayloadSchema", "Record", "Text", "get_schema", "register_schema", "self_check",
]
