"""Column expressions shared by the operators; all of them stay inside the JVM."""

from .documents import has_summarised_object, json_field, json_valid
from .text import is_blank, list_to_json, post_url, strip_zone_mark
from .times import lenient_timestamp

__all__ = ["has_summarised_object", "is_blank", "json_field", "json_valid", "lenient_timestamp", "list_to_json", "post_url", "strip_zone_mark"]
