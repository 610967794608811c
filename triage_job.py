"""Script for ``spark-submit``; same as ``python -m faultsift``."""

from faultsift.__main__ import main

main()
