"""lexispark: corpus cleaning, term and keyphrase analytics, exact splits,
TF-IDF / naive Bayes / logistic classifiers and evaluation reports as
Spark DataFrame jobs."""

__version__ = "0.1.0"
