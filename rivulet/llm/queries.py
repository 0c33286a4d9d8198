"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from .decontamination import OP6_SQL, op6_decontamination
from .html_text import op9_html_text
from .language import op5_language_id
from .line_dedup import OP1_SQL, op1_line_dedup
from .media import op3_media_columns
from .near_duplicates import OP4_SQL, op4_near_duplicates
from .packing import op7_packing
from .sharding import op10_shard_tree
from .token_counts import op8_token_counts
from .token_files import op2_token_files

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_media_columns": op3_media_columns,
    "op4_near_duplicates": op4_near_duplicates,
    "op5_language_id": op5_language_id,
    "op6_decontamination": op6_decontamination,
    "op7_packing": op7_packing,
    "op8_token_counts": op8_token_counts,
    "op9_html_text": op9_html_text,
    "op10_shard_tree": op10_shard_tree,
}

ORACLE_SQL: dict[str, str] = {
    "op1_line_dedup": OP1_SQL,
    "op4_near_duplicates": OP4_SQL,
    "op6_decontamination": OP6_SQL,
}
