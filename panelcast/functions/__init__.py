"""Column helpers, metrics and small numeric kernels shared by the operators."""
