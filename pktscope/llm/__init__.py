"""Training-data operators: quality rules, near-duplicate and substring
deduplication, benchmark decontamination, pseudonymised personal data, chat
formatting, packing, token files and web archives.

Nothing outside this package imports it (``__spark_entry__`` adds its queries
only when it can be imported).
"""
