"""The registered queries of this package, and the SQL that checks them."""

from holdfast.llm.chat_format import op2_chat_format
from holdfast.llm.decontaminate import op8_decontamination
from holdfast.llm.filter_audit import op12_filter_audit
from holdfast.llm.language_id import op7_language_id
from holdfast.llm.line_templates import op4_line_templates
from holdfast.llm.minhash import op5_minhash
from holdfast.llm.oracles import ORACLES
from holdfast.llm.packing import op9_packing
from holdfast.llm.quality_cascade import op11_quality_cascade
from holdfast.llm.simhash import op6_simhash
from holdfast.llm.substring_dedup import op1_substring_dedup
from holdfast.llm.suffix_dedup import op10_suffix_dedup
from holdfast.llm.warc import op3_warc
from holdfast.llm.whitening import op13_whitening

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_chat_format,
        op3_warc,
        op4_line_templates,
        op5_minhash,
        op6_simhash,
        op7_language_id,
        op8_decontamination,
        op9_packing,
        op10_suffix_dedup,
        op11_quality_cascade,
        op12_filter_audit,
        op13_whitening,
    )
}
