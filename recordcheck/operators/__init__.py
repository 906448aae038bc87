"""Rule model, evaluation and the derived outputs."""
