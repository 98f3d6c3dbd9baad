"""The registered queries of this subpackage, and their DuckDB statements where SQL can express them."""

from __future__ import annotations

from ampflow.llm.bpe import op10_bpe
from ampflow.llm.chat import op5_chat
from ampflow.llm.decontaminate import op2_decontamination
from ampflow.llm.html_crf import op1_html
from ampflow.llm.lexical import OP11_SQL, op11_lexical
from ampflow.llm.maxscore import OP3_SQL, op3_maxscore
from ampflow.llm.pieces import op12_pieces
from ampflow.llm.repair import op13_repair
from ampflow.llm.sharding import op9_feistel_shards
from ampflow.llm.simhash import op4_simhash
from ampflow.llm.simple8b import op6_simple8b
from ampflow.llm.toxicity import op8_toxicity
from ampflow.llm.url_templates import op7_url_templates

QUERIES = {
    f.__name__: f
    for f in (
        op1_html,
        op2_decontamination,
        op3_maxscore,
        op4_simhash,
        op5_chat,
        op6_simple8b,
        op7_url_templates,
        op8_toxicity,
        op9_feistel_shards,
        op10_bpe,
        op11_lexical,
        op12_pieces,
        op13_repair,
    )
}

STATEMENTS = {"op3_maxscore": OP3_SQL, "op11_lexical": OP11_SQL}
