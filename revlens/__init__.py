"""revlens: review analytics expressed as Spark DataFrame plans.

Layout
------
sources/    readers and writers (parquet, csv, json, word-vector text, model dirs, run registry)
functions/  Column-expression builders (text cleaning, labels, fixed word lists)
operators/  DataFrame -> DataFrame operators (profiling, splits, n-grams, TF-IDF,
            pooling, evaluation, classifiers, topic models, augmentation)
plans/      the registered queries over the supplied tables and their SQL oracles
streaming/  the same stateless transforms applied to a streaming source
"""

__version__ = "0.1.0"
