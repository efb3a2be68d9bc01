"""Operators for preparing training data: quality, tokens, chat, packing, near and exact copies,
licences, toxicity, contamination and mixing. Nothing else in the package imports this one."""
