"""Column expressions: JSON records, validation, risk scores, softmax."""
