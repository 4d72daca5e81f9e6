"""The registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from sendero.llm import bpe, decontaminate, exact_dedup, fill_middle, html_text, licences, ngram_join, prefix_trie, quality, suffix_dedup, token_shards, url_filter, warc

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_token_shards": token_shards.op2_token_shards,
    "op3_bpe": bpe.op3_bpe,
    "op4_quality": quality.op4_quality,
    "op5_html_text": html_text.op5_html_text,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_ngram_join": ngram_join.op8_ngram_join,
    "op9_warc": warc.op9_warc,
    "op10_licences": licences.op10_licences,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_url_filter": url_filter.op13_url_filter,
}
SQL = {
    "op1_decontaminate": decontaminate.SQL,
    "op7_exact_dedup": exact_dedup.SQL,
    "op9_warc": warc.SQL,
    "op11_fill_middle": fill_middle.SQL,
    "op12_prefix_trie": prefix_trie.SQL,
    "op13_url_filter": url_filter.SQL,
}
