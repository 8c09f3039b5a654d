"""martwright: cleaning, tagging, quality checks and reporting marts as Spark jobs.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing runs until the caller asks for a result, except where a
docstring says otherwise.
"""
