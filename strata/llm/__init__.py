"""Training-data operators: dedup, scans, scoring, extraction, tokens, chat.

One module per operator; nothing outside this package imports it.
"""
