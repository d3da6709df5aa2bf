"""millrace: DataFrame operators for preparing and evaluating retrieval training data."""
