"""tenor: a Spark-native engine for building, labelling and scoring text-safety corpora.

Every operator takes and returns DataFrames; nothing is collected to the
driver except fixed vocabularies of a few dozen rows.
"""

__version__ = "0.1.0"
