"""Registered queries of this package, with their SQL where SQL can state them."""

from __future__ import annotations

from ledgerloom.llm.bm25 import OP3_SQL, op3_topk_search
from ledgerloom.llm.collocations import OP11_SQL, op11_collocations
from ledgerloom.llm.common import ship
from ledgerloom.llm.decontamination import OP7_SQL, op7_decontamination
from ledgerloom.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from ledgerloom.llm.language import language_id_pages, op4_language_id
from ledgerloom.llm.line_dedup import OP1_SQL, op1_line_dedup
from ledgerloom.llm.mixing import op10_mixing
from ledgerloom.llm.ngram_jaccard import OP9_SQL, op9_ngram_jaccard
from ledgerloom.llm.secret_scan import op6_secret_scan
from ledgerloom.llm.sharding import op13_sharding
from ledgerloom.llm.token_files import op2_token_files
from ledgerloom.llm.url_filter import op8_url_filter
from ledgerloom.llm.warc import op5_warc

_ALL = {
    "op1_line_dedup": op1_line_dedup,
    "op2_token_files": op2_token_files,
    "op3_topk_search": op3_topk_search,
    "op4_language_id": op4_language_id,
    "language_id_pages": language_id_pages,
    "op5_warc": op5_warc,
    "op6_secret_scan": op6_secret_scan,
    "op7_decontamination": op7_decontamination,
    "op8_url_filter": op8_url_filter,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_mixing": op10_mixing,
    "op11_collocations": op11_collocations,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_sharding": op13_sharding,
}


def _bind(fn):
    def run(spark, folder):
        ship(spark)
        return fn(spark, folder)

    return run


QUERIES = {name: _bind(fn) for name, fn in _ALL.items()}
SQL = {
    "op1_line_dedup": OP1_SQL,
    "op3_topk_search": OP3_SQL,
    "op7_decontamination": OP7_SQL,
    "op9_ngram_jaccard": OP9_SQL,
    "op11_collocations": OP11_SQL,
    "op12_hard_negatives": OP12_SQL,
}
