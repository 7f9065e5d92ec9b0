"""Training, evaluation and scoring on Spark ML."""
