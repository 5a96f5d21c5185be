"""The catalog models and the jobs that compose the operators."""
