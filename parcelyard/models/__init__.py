"""Delay model: preprocessing, training, evaluation and scoring with Spark ML."""
