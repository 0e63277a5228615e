"""Jobs composed from the operators: factors, evaluation, features, metrics,
models, risk, portfolio, attribution, tail risk and text."""
