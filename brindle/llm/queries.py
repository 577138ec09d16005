"""Driver queries of the training-data operators, with SQL where it can express them."""

from __future__ import annotations

__all__ = ["ORACLE_SQL", "QUERIES"]

from brindle.llm.ann import op6_nearest
from brindle.llm.codes import op12_codes
from brindle.llm.decontaminate import op4_decontaminate
from brindle.llm.langid import op11_langid
from brindle.llm.mixing import op5_mixing
from brindle.llm.neardup import op7_neardup
from brindle.llm.oracle import ORACLE_SQL
from brindle.llm.pii import op2_pii
from brindle.llm.quality import op8_quality
from brindle.llm.ranking import op13_ranking
from brindle.llm.repeats import op10_substring
from brindle.llm.suffix import op1_suffix
from brindle.llm.toxicity import op3_toxicity
from brindle.llm.warc import op9_warc

QUERIES = {
    "op1_suffix": op1_suffix,
    "op2_pii": op2_pii,
    "op6_nearest": op6_nearest,
    "op4_decontaminate": op4_decontaminate,
    "op5_mixing": op5_mixing,
    "op3_toxicity": op3_toxicity,
    "op7_neardup": op7_neardup,
    "op8_quality": op8_quality,
    "op9_warc": op9_warc,
    "op10_substring": op10_substring,
    "op11_langid": op11_langid,
    "op12_codes": op12_codes,
    "op13_ranking": op13_ranking,
}
