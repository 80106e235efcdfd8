"""Entry script of the lake jobs: see ``shelfwise.jobs``."""

from shelfwise.jobs import main

if __name__ == "__main__":
    main()
