"""Script for spark-submit; see ludometry/__main__.py for its arguments."""

from ludometry.__main__ import main

if __name__ == "__main__":
    main()
