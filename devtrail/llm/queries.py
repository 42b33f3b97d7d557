"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from devtrail.llm import chat, embeddings, lines, mixing, packing, quality, search, secrets, simhash, topk, toxicity, trie, warc

QUERIES = {
    "op1_pack": packing.op1_pack,
    "op2_secret_scan": secrets.op2_secret_scan,
    "op3_quality": quality.op3_quality,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op5_chat_format": chat.op5_chat_format,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_embedding_dedup": embeddings.op7_embedding_dedup,
    "op8_line_dedup": lines.op8_line_dedup,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_simhash_dedup": simhash.op10_simhash_dedup,
    "op11_warc": warc.op11_warc,
    "op12_prefix_trie": trie.op12_prefix_trie,
    "op13_ranked_search": search.op13_ranked_search,
}

ORACLE = {
    "op4_mix_sources": mixing.OP4_SQL,
    "op5_chat_format": chat.OP5_SQL,
    "op7_embedding_dedup": embeddings.OP7_SQL,
    "op8_line_dedup": lines.OP8_SQL,
    "op9_exact_topk": topk.OP9_SQL,
    "op11_warc": warc.OP11_SQL,
    "op12_prefix_trie": trie.OP12_SQL,
    "op13_ranked_search": search.OP13_SQL,
}
