"""DataFrame-in / DataFrame-out operators.

* ``ranking``  - global order without a single-task window (range buckets)
* ``encode``   - frequency index, first-seen vocabulary, one-hot
* ``stats``    - masked moments, standardisation, scalar subqueries
* ``features`` - filters, imputation, label rules, vector assembly
* ``joins``    - dimension joins behind a checked broadcast bound
* ``boosting`` - histogram second-order boosting, model, save / load, dump
* ``evaluate`` - exact AUC, metric frames
* ``tuning``   - parameter grid, md5 split, train-validation selection
"""
