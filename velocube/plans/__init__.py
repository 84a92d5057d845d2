"""End-to-end jobs composed from the operators: feature build + monthly
report, training with champion/challenger promotion, inference + publish."""
