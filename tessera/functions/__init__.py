from .coerce import (copy_cast, empty_to_null, now, null_tokens, python_cast, strict,
                     to_bool, to_int, to_json_value, today)
from .variant import json_field, json_items

__all__ = ["copy_cast", "empty_to_null", "now", "null_tokens", "python_cast", "strict",
           "to_bool", "to_int", "to_json_value", "today", "json_field", "json_items"]
