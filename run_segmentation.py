"""Script for spark-submit; `python -m tillroll` does the same."""

from tillroll.__main__ import main

if __name__ == "__main__":
    main()
