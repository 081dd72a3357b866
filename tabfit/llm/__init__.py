"""Operators for preparing large training corpora.

Each module holds one operator (DataFrame in, DataFrame out) and the thin
``opN_<name>`` query that applies it to a whole table; ``queries`` lists them.
Nothing outside this subpackage imports it.

Rules shared by all operators:

* columns of the input that an operator does not know are passed through; an
  input column with the name of an output column is replaced by the output;
* a null text counts as the empty text unless the operator says otherwise;
* what is cut from lineage is written below ``spark.checkpoint.dir``.
"""
