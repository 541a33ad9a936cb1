"""SQL functions: text cleaning, parsing, masking, diagnostics.

Most functions take and return SQL expression text, for ``selectExpr``,
``where`` and ``F.expr``: ``df.selectExpr(f"{text.normalize_text('name')} as name")``.
An expression of any size then costs one call into the JVM, and rules can be
written and stored as text.
"""
