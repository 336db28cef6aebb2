import sys

from flowtally.cli import main

main(sys.argv[1:])
