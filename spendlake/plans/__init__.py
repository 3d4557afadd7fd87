"""The jobs: each one composes operators into a result frame."""
