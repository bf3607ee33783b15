"""The queries of this subpackage and, where SQL can express one over whole tables, its SQL."""

from __future__ import annotations

from . import op1_warc as op1
from .op1_warc import op1_warc
from .op10_html import op10_html
from .op2_quality import op2_quality
from .op3_packing import op3_packing
from .op4_simhash import op4_simhash
from .op5_decontam import op5_decontam
from .op6_tokens import op6_tokens
from .op7_media import op7_media
from .op8_langid import op8_langid
from .op9_suffix import op9_suffix

QUERIES = {f.__name__: f for f in (op1_warc, op2_quality, op3_packing, op4_simhash, op5_decontam, op6_tokens, op7_media, op8_langid, op9_suffix, op10_html)}

SQL: dict[str, str] = {"op1_warc": op1.SQL}
