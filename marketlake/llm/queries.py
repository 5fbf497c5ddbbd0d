"""Queries of this subpackage, one for each operator, and their SQL where SQL can say the same."""

from __future__ import annotations

from . import conversations, licenses
from .alignment import op13_alignment
from .byte_bpe import op12_byte_bpe
from .conversations import op11_conversations
from .decontam import op7_decontamination
from .licenses import op8_licenses
from .minhash import op1_minhash
from .packing import op3_packing
from .passages import op10_passages
from .pii import op2_pii
from .quality import op6_quality
from .sharding import op4_sharding
from .token_ids import op9_token_ids
from .warc import op5_warc

QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_pii": op2_pii,
    "op3_packing": op3_packing,
    "op4_sharding": op4_sharding,
    "op5_warc": op5_warc,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_licenses": op8_licenses,
    "op9_token_ids": op9_token_ids,
    "op10_passages": op10_passages,
    "op11_conversations": op11_conversations,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_alignment": op13_alignment,
}
ORACLE_SQL: dict[str, str] = {"op8_licenses": licenses.oracle(), "op11_conversations": conversations.oracle()}
