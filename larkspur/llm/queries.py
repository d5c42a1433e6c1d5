"""The queries of this subpackage by name. A query that SQL can express has its DuckDB text in ORACLES."""

from __future__ import annotations

from .ann import op7_nearest_neighbours
from .arc import op2_warc
from .bpe import op8_byte_level_bpe
from .htmltext import op9_html_extraction
from .linededup import op10_line_dedup
from .mpegts import op1_mpeg_transport_streams
from .packing import op5_best_fit_packing
from .pii import op6_pii
from .simhash import op3_simhash_near_dedup
from .toxicity import op4_toxicity

QUERIES = {
    "op1_mpeg_transport_streams": op1_mpeg_transport_streams,
    "op2_warc": op2_warc,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_pii": op6_pii,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_byte_level_bpe": op8_byte_level_bpe,
    "op9_html_extraction": op9_html_extraction,
    "op10_line_dedup": op10_line_dedup,
}

ORACLES: dict[str, str] = {}
