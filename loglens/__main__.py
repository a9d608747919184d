import sys

from loglens.cli import main

sys.exit(main())
