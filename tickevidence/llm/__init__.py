"""Operators that prepare text corpora for training. Nothing else in the library imports this subpackage.

Rules of all operators here, besides those in their docstrings:

* every function is ``DataFrame -> DataFrame`` and lazy unless it must fit a
  model or stage a table; staged tables go to ``spark.checkpoint.dir``;
* a NULL text counts as empty and keeps its row; a NULL doc_id is a key like any
  other; repeated rows stay repeated rows; an empty table gives an empty result;
* only the columns an operator needs are read, so further columns, whatever
  their names, neither clash nor travel.
"""
