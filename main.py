"""Script for ``spark-submit``."""

from txrisk.cli import main

if __name__ == "__main__":
    main()
