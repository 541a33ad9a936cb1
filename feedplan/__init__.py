"""feedplan - record synchronisation on Spark DataFrames.

A messy feed goes in; a typed canonical table, row diagnostics and a
create / update / skip / conflict plan against a snapshot come out.  Every
operator takes DataFrames or Columns and returns DataFrames or Columns; only
explicit writers have side effects.
"""
